"""Shared folder: the cluster's setting wins."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from leadforge.session import local_session, scratch_path, durable
spark = local_session(2, spark__checkpoint__dir={folder!r})
assert scratch_path(spark, "x").startswith({folder!r})
assert durable(spark.range(5)).count() == 5
import os
assert os.listdir({folder!r})
from leadforge.sources import files
import pathlib
(pathlib.Path({folder!r}) / "b").mkdir()
(pathlib.Path({folder!r}) / "b" / "f.txt").write_text("A|B\\n1|2\\n")
good, _ = files.scan_delimited(spark, files.file_inventory(spark, {folder!r} + "/b"))
assert good.select("A", "B").collect() == [("1", "2")]
"""


def test_named_folder_is_used_and_tasks_need_no_package(tmp_path):
    """Runs in its own process, away from the repository, as a driver program would."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = str(tmp_path / "shared")
    os.makedirs(folder)
    code = SCRIPT.format(repo=repo, folder=folder)
    subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), check=True, timeout=300)
