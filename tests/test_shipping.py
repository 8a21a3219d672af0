"""The package as executors get it: a zip file, without the folder of the repository."""

from __future__ import annotations

import importlib.util
import os
import subprocess
import sys
import threading
import time
import zipfile
from pathlib import Path
from types import SimpleNamespace

import pytest

from reviewflow import storage

ROOT = Path(__file__).resolve().parent.parent


def test_every_module_comes_from_the_zip_alone():
    got = []
    storage.ship_package(SimpleNamespace(sparkContext=SimpleNamespace(applicationId="test-shipping", addPyFile=got.append)))
    modules = [n.removesuffix(".py").removesuffix("/__init__").replace("/", ".") for n in zipfile.ZipFile(got[0]).namelist() if n.endswith(".py")]
    assert "reviewflow.conf.values" in modules and "reviewflow.operators.identity" in modules
    code = f"import importlib, sys; sys.path.insert(0, {got[0]!r}); [importlib.import_module(m) for m in {modules!r}]; assert sys.modules['reviewflow'].__file__.startswith({got[0]!r})"
    ran = subprocess.run([sys.executable, "-I", "-c", code], capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]


RUN = """
import sys
sys.path.insert(0, {root!r})  # of this process only; the workers get what is shipped
from pyspark.sql import SparkSession
from reviewflow.operators import identity
from reviewflow.plans import catalog
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
spark.createDataFrame([(1, "Customer#1"), (2, " Ü 名 "), (3, "  "), (4, None)], "c_custkey long, c_name string").write.parquet("customer.parquet")
for name, platform, display, values in (("hash_account", "youtube", False, "1234"), ("hash_display", "bilibili", True, ["Customer#1", "Ü 名", None, None])):
    got = {{r.c_custkey: r.hash for r in getattr(catalog, name)(spark, ".").collect()}}
    assert got == {{i: v and identity.pseudonym(v, catalog.TEST_PROJECT, platform, display) for i, v in enumerate(values, 1)}}, (name, got)
    print(name, "equal")
"""


@pytest.mark.parametrize("name", ["hash_account", "hash_display"])
def test_digests_by_workers_outside_the_repository(ran_outside, name):
    assert f"{name} equal" in ran_outside.stdout, ran_outside.stderr[-2000:]


@pytest.fixture(scope="module")
def ran_outside(tmp_path_factory):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", RUN.format(root=str(ROOT))], cwd=tmp_path_factory.mktemp("outside"), env=env, capture_output=True, text=True, timeout=600)


def imported_anew():
    spec = importlib.util.spec_from_file_location("reviewflow_storage_anew", storage.__file__)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def session(application: str, got: list[str], seconds: float = 0):
    def add(path: str) -> None:
        time.sleep(seconds)
        got.append(path)

    return SimpleNamespace(sparkContext=SimpleNamespace(applicationId=application, addPyFile=add))


def test_first_queries_at_once_ship_one_file():
    got: list[str] = []
    spark = session("test-at-once", got, 0.3)
    at_once = [threading.Thread(target=storage.ship_package, args=(spark,)) for _ in range(4)]
    for t in at_once:
        t.start()
    for t in at_once:
        t.join()
    assert len(got) == 1


def test_package_imported_anew_ships_no_second_file():
    got: list[str] = []
    spark = session("test-anew", got)
    for module in (storage, imported_anew(), imported_anew()):
        module.ship_package(spark)
    assert len(got) == 1


def test_changed_package_is_an_error_within_one_application():
    spark, anew = session("test-changed", []), imported_anew()
    storage.ship_package(spark)
    anew._package = lambda: {"reviewflow/__init__.py": b""}
    with pytest.raises(RuntimeError, match="was changed"):
        anew.ship_package(spark)
    anew.ship_package(session("test-changed-next", []))


ANEW = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.executor.memory", "600m").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
spark.createDataFrame([(1, "Customer#1"), (2, None)], "c_custkey long, c_name string").write.parquet({folder!r} + "/customer.parquet")
for name in ("hash_account", "hash_display"):
    for m in [m for m in sys.modules if m.partition(".")[0] == "reviewflow"]:
        del sys.modules[m]
    from reviewflow.plans import catalog
    print(name, [len(r.hash or "") for r in getattr(catalog, name)(spark, {folder!r}).orderBy("c_custkey").collect()])
"""


def test_package_imported_anew_on_executors(tmp_path):
    import pyspark

    (tmp_path / "home/work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():  # the executors' logs go to work in Spark's home
        if p.name != "work":
            (tmp_path / "home" / p.name).symlink_to(p)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_HOME": str(tmp_path / "home"), "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable}
    ran = subprocess.run([sys.executable, "-c", ANEW.format(root=str(ROOT), folder=str(tmp_path))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "hash_account [64, 64]" in ran.stdout and "hash_display [64, 0]" in ran.stdout, ran.stderr[-2000:]
