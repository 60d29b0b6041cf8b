"""Readers of an ingest's tables never miss them, whatever stops a batch and wherever."""

import datetime as dt

import pytest
from pyspark.sql.types import DateType, StringType, StructField, StructType

from panelkit.session import work_dir
from panelkit.sources import snapshots as S
from panelkit.streaming import ingest, versions

SCHEMA = StructType([StructField("document_number", StringType()), StructField("publication_date", DateType())])
LANDED = "document_number string, publication_date date, dt date, lang string"


class Killed(Exception):
    pass


@pytest.fixture
def store(spark):
    base = work_dir(spark, "t_versions")

    def land(*rows):
        S.land(spark.createDataFrame([(n, dt.date(2025, 1, 1), dt.date(*d), "en") for n, d in rows], LANDED), f"{base}/landing")

    def run():
        ingest.ingest_available_now(spark, f"{base}/landing", SCHEMA, f"{base}/mirror", f"{base}/curated",
                                    f"{base}/manifest", f"{base}/_ckpt", lambda df: df.select("document_number"))

    def curated():
        got = ingest.read_curated(spark, f"{base}/curated")
        return None if got is None else sorted(str(r[0]) for r in got.collect())

    def manifest():
        got = ingest.read_manifest(spark, f"{base}/manifest")
        return None if got is None else {str(r.dt): (r.n_records, r.max_number, r.n_bad_numbers) for r in got.collect()}

    return base, land, run, curated, manifest


NEW, OLD = (2025, 2, 8), (2025, 2, 1)


@pytest.mark.parametrize("table", ["manifest", "curated"])
@pytest.mark.parametrize("step", ["before write", "before commit", "after commit"])
def test_a_crash_anywhere(spark, store, monkeypatch, table, step):
    base, land, run, curated, manifest = store
    land(("1", OLD), ("2", NEW))
    run()
    assert curated() == ["2"] and manifest() == {"2025-02-01": (1, 1, 0), "2025-02-08": (1, 2, 0)}
    write, commit = versions.write, versions.commit

    def kill_write(df, root, version):
        if step == "before write" and root.endswith(table):
            raise Killed
        write(df, root, version)

    def kill_commit(session, root, version):
        if step == "before commit" and root.endswith(table):
            raise Killed
        commit(session, root, version)
        if step == "after commit" and root.endswith(table):
            raise Killed

    monkeypatch.setattr(versions, "write", kill_write)
    monkeypatch.setattr(versions, "commit", kill_commit)
    land(("3", NEW), ("x", NEW), ("9", OLD))
    with pytest.raises(Exception):
        run()
    # a reader gets the old or the new version, whole
    assert curated() in (["2"], ["2", "3", "x"])
    assert manifest() in ({"2025-02-01": (1, 1, 0), "2025-02-08": (1, 2, 0)}, {"2025-02-01": (2, 9, 0), "2025-02-08": (3, 3, 1)})
    monkeypatch.undo()
    run()  # the batch runs again; nothing is counted twice
    assert curated() == ["2", "3", "x"]
    assert manifest() == {"2025-02-01": (2, 9, 0), "2025-02-08": (3, 3, 1)}


def test_only_batches_with_newest_records_rebuild(spark, store):
    base, land, run, curated, manifest = store
    assert curated() is None and manifest() is None
    land(("1", (2025, 1, 1)))  # not after the floor
    run()
    assert curated() == [] and manifest() == {"2025-01-01": (1, 1, 0)}
    land(("2", NEW))
    run()
    built = versions.committed(spark, f"{base}/curated")
    land(("3", OLD))
    run()
    assert versions.committed(spark, f"{base}/curated") == built and curated() == ["2"]
    assert manifest()["2025-02-01"] == (1, 3, 0)
    for i in range(ingest.KEEP_VERSIONS + 1):
        land((str(10 + i), NEW))
        run()
    assert len(versions.committed(spark, f"{base}/curated")) == ingest.KEEP_VERSIONS
    assert curated() == sorted(["2", *(str(10 + i) for i in range(ingest.KEEP_VERSIONS + 1))])


def test_committed_versions_are_not_written_again(spark):
    root = work_dir(spark, "t_version")
    versions.write(spark.range(3), root, 4)
    assert versions.read_current(spark, root) is None
    versions.write(spark.range(5), root, 4)  # not committed yet
    versions.commit(spark, root, 4)
    with pytest.raises(ValueError):
        versions.write(spark.range(1), root, 4)
    assert versions.read_current(spark, root).count() == 5 and versions.applied(spark, root, 3)
