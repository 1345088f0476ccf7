"""DataFrame operators of the change-data-capture engine."""
