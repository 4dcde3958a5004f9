"""Python workers find the package when neither the folder nor PYTHONPATH shows it to them."""

import os
import pathlib
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from loomspan.session import local_session, with_package
from loomspan.operators import hits
spark = with_package(local_session(2, 2, "1g"))
rows = [(1, 2, 1, 50, 1, 50, 9, 9, 50, 1)]
df = spark.createDataFrame(rows, "q long, t long, qb long, qe long, tb long, te long, bits long, ident long, aln long, row_no long")
print("rows", hits.chain_sums(df).count())
"""


def test_workers_from_another_folder(tmp_path):
    root = str(pathlib.Path(__file__).resolve().parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1" in said.stdout, said.stderr[-2000:]
