"""Python workers do not carry the memory of earlier tasks along."""

import subprocess
import sys

SCRIPT = """
import re
import numpy as np
import pyarrow as pa
from tidefold.llm.common import give_back

def mb():
    text = open("/proc/self/smaps_rollup").read()
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", text))) // 1024

give_back()
before = mb()
words = pa.array(["word %09d" % k for k in range(3_000_000)])
parts = [np.ones(2_000) for _ in range(8_000)]
last = parts[-1]
del words, parts
kept = mb()
give_back()
print(before, kept, mb())
"""


def test_what_a_task_freed_goes_back_to_the_system():
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, check=True)
    before, kept, after = map(int, out.stdout.split())
    assert kept > before + 100 and after < before + 50, out.stdout
