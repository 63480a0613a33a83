import os
import subprocess
import sys

import stratus

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(stratus.__file__)))

CODE = """
import sys; sys.path.insert(0, {root!r})
from stratus.session import get_session
spark = get_session("local[2]", shuffle_partitions=2)
from stratus.llm import ann, passages, langid
rows = spark.createDataFrame([(i, [float(i), 1.0, 2.0]) for i in range(40)], "vec_id long, embedding array<float>")
assert ann.op1_ann(rows).count() > 0
docs = spark.createDataFrame([(i, "some words that are here " * 20, "en") for i in range(3)], "doc_id long, text string, lang string")
assert passages.passages(docs).count() == 2
assert langid.op5_langid(docs).count() == 3
"""


def test_operators_run_from_a_foreign_folder(tmp_path):
    """Workers find the package though it is neither installed nor in their folder."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
