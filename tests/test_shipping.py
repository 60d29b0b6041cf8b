"""The package reaches the Python workers also where it is not on their path."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from panelkit import get_session
from pyspark.sql import functions as F
spark = get_session("local[1]", shuffle_partitions=1)
def there(pdf):
    import panelkit.operators.tsstats as m
    return pdf.assign(path=m.__file__)
got = spark.range(1).groupBy("id").applyInPandas(there, "id long, path string").first()
print("FOUND", got.path)
"""


def test_grouped_map_finds_the_package_from_another_folder(tmp_path):
    repo = Path(__file__).resolve().parents[1]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, str(repo)], cwd=tmp_path, env=env, text=True,
                         capture_output=True, timeout=180)
    assert "FOUND" in run.stdout, run.stderr[-2000:]
