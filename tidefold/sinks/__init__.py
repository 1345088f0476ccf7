"""Writers: folded state, bulk text, JDBC, and fan-out over several of them."""
