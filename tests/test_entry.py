"""The driver's contract, and where long plans are cut."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tessera.operators import stages


def test_only_a_missing_subpackage_is_forgiven(tmp_path):
    """A module that is there and broken stops the import; one that is taken out does not."""
    code = "import sys; sys.path.insert(0, {!r}); sys.path.insert(1, {!r}); import __spark_entry__ as e; print(len(e.queries()))"
    root = entry.__file__.rpartition("/")[0]
    (tmp_path / "corpus_pipeline.py").write_text("from tessera.llm import no_such_module\n" if entry.llm else "import no_such_module\n")
    run = subprocess.run([sys.executable, "-c", code.format(str(tmp_path), root)], capture_output=True, text=True, cwd=tmp_path)
    assert run.returncode and "ImportError" in run.stderr + run.stderr.replace("ModuleNotFoundError", "ImportError")
    (tmp_path / "corpus_pipeline.py").write_text("raise ModuleNotFoundError('taken out', name='tessera.llm')\n")
    run = subprocess.run([sys.executable, "-c", code.format(str(tmp_path), root)], capture_output=True, text=True, cwd=tmp_path)
    assert run.returncode == 0 and int(run.stdout) > 40


class _Cluster:
    """A session of several machines that names no checkpoint folder."""

    def __init__(self):
        self.sparkSession = self.sparkContext = self._jsc = self.conf = self
        self.master = "spark://somewhere:7077"

    def sc(self):
        return self

    def getCheckpointDir(self):
        return self

    def isEmpty(self):
        return True

    def get(self, key, default=None):
        return default


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        stages.stage(_Cluster())
    cluster = _Cluster()
    cluster.master = "local-cluster[3,2,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        stages.stage(cluster)
