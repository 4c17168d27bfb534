import __spark_entry__ as ent
from quarry.plans.registry import REGISTRY
from conftest import SF_SMALL


def test_every_oracle_has_a_query():
    q, sql = ent.queries(), ent.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 100


def test_names_are_plain():
    for name in ent.queries():
        assert name.replace("_", "").isalnum()
        assert name in REGISTRY or name == "pipeline" or (name.startswith("op") and name[2].isdigit())


def test_entry_runs(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert df.columns == ["l_suppkey", "l_partkey", "revenue", "rank"]
    assert rows and all(1 <= r["rank"] <= 3 for r in rows)


def test_oracle_sql_needs_no_session():
    # the driver may read the SQL before any session exists
    import subprocess
    import sys

    code = "import __spark_entry__ as e; print(len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ent.os.path.dirname(ent.__file__))
    assert out.returncode == 0, out.stderr
