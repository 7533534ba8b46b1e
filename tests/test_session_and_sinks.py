from __future__ import annotations

import os
import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom import session, staging
from ledgerloom.functions import user_slug
from ledgerloom.session import NamespaceTaken, configure, open_namespace, session_user
from ledgerloom.sinks import append_new, create_once, publish, replace_table, replace_view, versions


@pytest.fixture
def ns(spark, tmp_path):
    yield open_namespace(spark, prefix=f"ns_{tmp_path.name}_".lower(), location=str(tmp_path))
    spark.sql("USE spark_catalog.default")


def test_slug(spark):
    users = ["a.b@x", "a_b@y", "Über+Q@z.example", "plain", "", "two@at@signs"]
    rows = spark.createDataFrame([(u,) for u in users], "u string").select(
        user_slug(F.col("u")).alias("s")
    )
    assert [r["s"] for r in rows.collect()] == [
        "handson_a_b", "handson_a_b", "handson__ber_q", "handson_plain", "handson_",
        "handson_two",
    ]


def test_namespace_falls_back_to_the_current_catalog(spark, ns):
    user, catalog = session_user(spark)
    assert (ns.user, ns.catalog) == (user, catalog)
    assert spark.catalog.currentDatabase() == ns.schema
    assert ns.table("t") == f"`{catalog}`.`{ns.schema}`.`t`"


def test_a_schema_belongs_to_its_first_user(spark, tmp_path, monkeypatch):
    at = {"prefix": f"own_{tmp_path.name}_".lower(), "location": str(tmp_path / "s")}
    users = {"now": "a.b@x"}
    monkeypatch.setattr(session, "session_user", lambda _: (users["now"], "spark_catalog"))
    first = open_namespace(spark, **at)
    create_once(spark.range(3), first.table("t"))
    spark.sql("USE spark_catalog.default")
    users["now"] = "a_b@y"
    with pytest.raises(NamespaceTaken, match="another user than a_b@y"):
        open_namespace(spark, **at)
    assert spark.catalog.currentDatabase() == "default"
    users["now"] = "a.b@x"
    assert open_namespace(spark, **at) == first and spark.table(first.table("t")).count() == 3
    # A schema from before owners were recorded is its next user's.
    old = f"old_{tmp_path.name}_a_b".lower()
    spark.sql(f"CREATE SCHEMA {old} LOCATION '{tmp_path / 'o'}'")
    old_at = {"prefix": old.removesuffix("a_b")}
    assert open_namespace(spark, **old_at).schema == old
    users["now"] = "a_b@y"
    with pytest.raises(NamespaceTaken):
        open_namespace(spark, **old_at)
    spark.sql("USE spark_catalog.default")


def test_configure(spark):
    assert configure(spark).conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_create_once_ignores_a_second_query(spark, ns):
    create_once(spark.range(3).toDF("a"), ns.table("t"))
    again = create_once(spark.range(9).selectExpr("id AS b", "id AS c"), ns.table("t"))
    assert again.columns == ["a"] and again.count() == 3


def test_replace_changes_rows_and_schema_and_may_read_itself(spark, ns):
    name = ns.table("t")
    replace_table(spark.range(3).toDF("a"), name)
    replace_table(spark.range(5).selectExpr("id AS b"), name)
    replaced = replace_table(spark.table(name).where("b > 2"), name)
    assert sorted(r["b"] for r in replaced.collect()) == [3, 4]


def test_replace_reports_other_errors(spark):
    with pytest.raises(AnalysisException):
        replace_table(spark.range(1), "`spark_catalog`.`no_such_schema`.`t`")


def test_readers_of_a_published_table_find_old_or_new(spark, ns):
    name = ns.table("p")
    publish(spark.range(3).toDF("a"), name)
    opened, seen, errors, done = spark.table(name), [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(spark.table(name).count())
            except Exception as error:  # noqa: BLE001 - any failure of a reader counts
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in (5, 7):
        publish(spark.range(n).selectExpr("id AS b"), name, keep=3)
    done.set()
    reader.join()
    assert not errors and set(seen) <= {3, 5, 7} and seen == sorted(seen)
    assert spark.table(name).columns == ["b"] and opened.count() == 3


def test_published_versions_expire_and_failures_change_nothing(spark, ns):
    name = ns.table("p")
    for n in range(1, 5):
        publish(spark.range(n).toDF("a"), name)
    assert [n for n, _ in versions(spark, name)] == [3, 4]
    with pytest.raises(Exception, match="no such row"):
        publish(spark.table(name).select(F.raise_error(F.lit("no such row")).alias("a")), name)
    assert spark.table(name).count() == 4
    grown = publish(spark.table(name).unionByName(spark.table(name)), name, keep=1)
    assert grown.count() == 8 and len(versions(spark, name)) == 1
    create_once(spark.range(2), ns.table("plain"))
    with pytest.raises(AnalysisException):
        publish(spark.range(1), ns.table("plain"))


def test_replace_view(spark, ns):
    create_once(spark.range(3).toDF("a"), ns.table("t"))
    view = ns.table("v")
    replace_view(spark, view, f"SELECT a FROM {ns.table('t')} WHERE a > 0")
    assert replace_view(spark, view, f"SELECT a + 1 AS b FROM {ns.table('t')}").columns == ["b"]


def test_append_stores_each_key_once(spark, ns):
    name = ns.table("log")
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, what string")
    create_once(batch.limit(0), name)
    assert append_new(batch, name, ["id"]).count() == 2
    more = batch.unionByName(spark.createDataFrame([(3, "d")], "id int, what string"))
    assert append_new(more, name, ["id"]).count() == 1
    rows = sorted((r["id"], r["what"]) for r in spark.table(name).collect())
    assert rows == [(1, "a"), (2, "c"), (3, "d")]


def test_append_by_all_columns_and_hot_key(spark, ns):
    name = ns.table("keys")
    hot = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS id")
    create_once(hot.limit(0), name)
    append_new(hot, name, ["id"])
    append_new(hot, name, ["id"])
    assert spark.table(name).count() == spark.table(name).distinct().count() == 2001


def test_append_refuses_null_keys(spark, ns):
    name = ns.table("log")
    batch = spark.createDataFrame([(None, "b")], "id int, what string")
    create_once(batch.limit(0), name)
    with pytest.raises(Exception, match="null key column id"):
        append_new(batch, name, ["id"])


def test_checkpoint_folder_is_the_configured_one(spark):
    assert staging.checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(5), "five")
    assert staged.count() == 5 and staging.checkpoint_folder(spark) in staged.inputFiles()[0]


class Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Session:
    def __init__(self, **values):
        self.conf = Conf(**values)


def test_cluster_without_checkpoint_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.checkpoint_folder(Session(**{"spark.master": "yarn"}))
    local = Session(**{"spark.master": "local[2]", "spark.app.id": "x"})
    assert staging.checkpoint_folder(local) == staging.checkpoint_folder(local)


class Settings(dict):
    @property
    def conf(self):
        return self


@pytest.mark.parametrize("master", ["", "yarn", "local-cluster[2,1,1024]", "spark://host:7077"])
def test_a_session_not_known_to_be_local_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        staging.checkpoint_folder(Settings({"spark.master": master}))
    given = Settings({"spark.master": master, "spark.checkpoint.dir": "file:///shared/"})
    assert staging.checkpoint_folder(given) == "file:///shared"


def test_staged_tables_are_dropped(spark, monkeypatch):
    monkeypatch.setattr(staging, "_made", [])
    kept = staging.stage(spark.range(3).withColumn("part", F.col("id") % 2), "gone", "part")
    assert sorted(r["id"] for r in kept.where("part = 0").collect()) == [0, 2]
    folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://")).rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    staging.drop_staged()
    assert not os.path.exists(folder)


def test_private_schemas_are_dropped(spark, monkeypatch):
    from ledgerloom.contract import tables

    monkeypatch.setattr(tables, "_private", [])
    before = {r[0] for r in spark.sql("SHOW SCHEMAS").collect()}
    with tables.private_namespace(spark) as private:
        open_namespace(spark, **private)
    assert {r[0] for r in spark.sql("SHOW SCHEMAS").collect()} - before
    tables.drop_private()
    assert {r[0] for r in spark.sql("SHOW SCHEMAS").collect()} == before
