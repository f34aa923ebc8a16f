import subprocess
import sys

from pyspark import cloudpickle

from tidemark.operators.similarity import _Block, _nearness


def test_executors_do_not_need_the_package(tmp_path):
    path = tmp_path / "task.pickle"
    path.write_bytes(cloudpickle.dumps((_nearness("cosine", [0.1], False), _Block)))
    code = f"import pickle, sys; pickle.load(open({str(path)!r}, 'rb')); assert 'tidemark' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin"})
