"""A bare session (no spark-defaults, so no spark.checkpoint.dir) must still checkpoint."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
assert s.conf.get('spark.checkpoint.dir', None) is None
from hourglass.session import ensure_checkpoint_dir, shared_folder, cut_lineage
app = ensure_checkpoint_dir(s)
assert app.rstrip('/').rsplit('/', 1)[0].endswith(shared_folder(s).split(':', 1)[-1])
assert cut_lineage(s.range(5)).count() == 5
print('OK')
"""


def test_bare_session_checkpoints(tmp_path):
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=300)
    assert "OK" in out.stdout, out.stderr[-2000:]
