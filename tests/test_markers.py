"""One-line files, exports that switch at once, loads by file and version claims."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tollgate.operators.registry import read_registry, register
from tollgate.operators.train import training_rows
from tollgate.plans import export_latest, latest, prepare
from tollgate.plans.prepare import write_latest
from tollgate.sources import exports
from tollgate.sources.exports import drop_old_exports, read_export, switch_export, write_export
from tollgate.sources.files import load_new, load_unlisted, new_files, read_clean, scan_text
from tollgate.sources.logs import REGISTRY
from tollgate.sources.markers import claim, read_line, remove, switch
from tollgate.spec import DatasetSpec, schema_of

SPEC = DatasetSpec(
    name="payments",
    schema=schema_of(id="long", at="timestamp_ntz", amount="double", mark="string"),
    key=("id",),
    event_time="at",
    label="fraud",
    label_expr="CAST(mark = 'yes' AS INT)",
    numeric=("amount",),
    required=("id",),
    partition_cols=("mark",),
    delimiter=";",
)
DAY = date(2020, 1, 1)


def drop(spark, lines, path):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_a_line_is_switched_whole(spark, path):
    assert read_line(spark, path("a/line")) is None
    for text in ("one", "two ü"):
        switch(spark, path("a/line"), text)
        assert read_line(spark, path("a/line")) == text
    remove(spark, [path("a/line"), path("never")])
    assert read_line(spark, path("a/line")) is None


def test_of_many_claims_one_succeeds(spark, path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda _: claim(spark, path("claims/1")), range(16)))
    assert won.count(True) == 1


def test_concurrent_validations_get_versions_of_their_own(spark, path):
    given = [("m", f"uri{i}", "auc", 0.5, 0.1, 10, None, None) for i in range(6)]
    names = "model_name string, model_uri string, metric_name string, metric_mean double, metric_var double, n_rep int, t_stat double, p_value double"
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda g: register(spark, spark.createDataFrame([g], names), path("registry")), given))
    rows = read_registry(spark, path("registry")).collect()
    assert sorted(r.version for r in rows) == list(range(1, 7)) and len({r.model_uri for r in rows}) == 6
    register(spark, spark.createDataFrame([], names), path("registry"))
    assert read_registry(spark, path("registry")).count() == 6
    assert read_registry(spark, path("registry")).schema == spark.createDataFrame([], REGISTRY).schema


def table(spark, out):
    return sorted((r.id, r.place) for r in read_export(spark, out, spark.createDataFrame([], "id long, place string").schema).collect())


def test_a_table_is_old_or_new_and_nothing_between(spark, path, monkeypatch):
    out = path("out")
    rows = lambda *r: spark.createDataFrame(list(r), "id long, place string")
    assert table(spark, out) == []
    switch_export(spark, out, write_export(spark, rows((1, "a b"), (2, "c%/="), (3, None), (4, "d")), out, ["place"], None))
    first = [(1, "a b"), (2, "c%/="), (3, None), (4, "d")]
    assert sorted(table(spark, out), key=str) == sorted(first, key=str)
    moved = rows((2, "a b"), (1, "a b"))  # 2 moves, and its old place is empty
    export = write_export(spark, moved, out, ["place"], rows((1, "a b"), (2, "c%/=")).select("place"))
    assert sorted(table(spark, out), key=str) == sorted(first, key=str)
    switch_export(spark, out, export)
    second = [(1, "a b"), (2, "a b"), (3, None), (4, "d")]
    assert sorted(table(spark, out), key=str) == sorted(second, key=str)

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(exports, "write_clean", crash)
    with pytest.raises(OSError):
        write_export(spark, moved, out, ["place"], None)
    monkeypatch.undo()
    write_export(spark, rows((9, "x")), out, ["place"], None)  # written, never switched to
    assert len(drop_old_exports(spark, out, timedelta(0))) == 2
    assert sorted(table(spark, out), key=str) == sorted(second, key=str)
    nothing = write_export(spark, rows(), out, ["place"], rows((1, "a b"), (3, None), (4, "d")).select("place"))
    switch_export(spark, out, nothing)
    assert table(spark, out) == []


def test_an_export_without_partitions(spark, path):
    for n in (3, 2):
        switch_export(spark, path("out"), write_export(spark, spark.range(n), path("out"), (), None))
    assert read_export(spark, path("out"), spark.range(1).schema).count() == 2


def test_training_takes_the_row_that_the_export_holds(spark, path):
    """Two rows of a key in one load, one row each in loads of two checkpoints."""
    places = path("raw"), path("check"), path("clean")
    drop(spark, ["1;2024-01-01 10:00:00;9.0;no", "1;2024-01-01 12:00:00;5.0;yes", "2;2024-01-01 10:00:00;1.0;no"], places[0])
    prepare(spark, SPEC, *places)
    drop(spark, ["2;2024-01-01 09:00:00;7.0;yes", "3;2024-01-01 10:00:00;2.0;no"], path("other"))
    prepare(spark, SPEC, path("other"), path("check2"), places[2])
    export_latest(spark, SPEC, places[2], path("latest"), DAY)
    exported = {r.id: (r.amount, r.mark) for r in latest(spark, SPEC, path("latest")).collect()}
    assert exported == {1: (5.0, "yes"), 2: (7.0, "yes"), 3: (2.0, "no")}
    trained = training_rows(spark, SPEC, places[2], DAY).collect()
    assert {r.id: (r.amount, r.mark) for r in trained} == exported
    assert {r.id: r.fraud for r in trained} == {1: 1, 2: 1, 3: 0}


def test_a_failed_export_leaves_the_old_table(spark, path):
    places = path("raw"), path("check"), path("clean")
    drop(spark, ["1;2024-01-01 10:00:00;9.0;no", "2;2024-01-01 10:00:00;9.0;no"], places[0])
    prepare(spark, SPEC, *places)
    export_latest(spark, SPEC, places[2], path("latest"), DAY)
    drop(spark, ["1;2024-01-02 10:00:00;9.0;yes"], places[0])
    prepare(spark, SPEC, *places)
    write_latest(spark, SPEC, places[2], path("latest"), DAY)
    read = lambda: sorted((r.id, r.mark) for r in latest(spark, SPEC, path("latest")).collect())
    assert read() == [(1, "no"), (2, "no")]
    export_latest(spark, SPEC, places[2], path("latest"), DAY)
    assert read() == [(1, "yes"), (2, "no")]


def test_a_load_keeps_its_id_and_day_at_every_try(spark, path):
    drop(spark, ["1;2024-01-01 10:00:00;9.0;no"], path("raw"))
    switch(spark, path("check/loads/00000000"), "20240102T030405000006")  # the first try
    (load,) = load_new(spark, path("raw"), SPEC, path("check"), path("clean"))
    assert load.startswith("20240102T030405000006-") and load.endswith("-00000000")
    assert read_clean(spark, SPEC, path("clean")).first().load_date == date(2024, 1, 2)
    assert read_clean(spark, SPEC, path("clean"), loads=[load]).count() == 1
    assert read_clean(spark, SPEC, path("clean"), since=date(2024, 1, 3)).count() == 0


def test_only_the_folders_asked_for_are_listed(spark, path):
    for day in ("20240101", "20240102"):
        drop(spark, [f"{day};2024-01-01 10:00:00;9.0;no"], path(f"raw{day}"))
        switch(spark, path(f"check{day}/loads/00000000"), f"{day}T000000000000")
        load_new(spark, path(f"raw{day}"), SPEC, path(f"check{day}"), path("clean"))
    late = read_clean(spark, SPEC, path("clean"), since=date(2024, 1, 2))
    assert [r.id for r in late.collect()] == [20240102]
    assert all("load_date=2024-01-02" in f for f in late.inputFiles())


def test_old_files_are_not_opened(spark, path):
    drop(spark, ["1;2024-01-01 10:00:00;9.0;no"], path("raw"))
    assert len(load_unlisted(spark, path("raw"), SPEC, path("manifest"), path("clean"))) == 1
    for i in range(3):
        drop(spark, [f"{i + 2};2024-01-01 10:00:00;9.0;no"], path("raw"))
    listed = spark.read.schema("file_path string, load bigint").parquet(path("manifest/files"))
    names = new_files(spark, path("raw"), listed)
    scanned = scan_text(spark, names, SPEC).inputFiles()
    old = {r.file_path for r in listed.collect()}
    assert len(scanned) == 3 and not old & {f.replace("file:///", "file:///") for f in scanned}
    assert len(new_files(spark, path("raw"), listed, limit=2)) == 2
    loads = load_unlisted(spark, path("raw"), SPEC, path("manifest"), path("clean"), max_files=2)
    assert len(loads) == 2 and load_unlisted(spark, path("raw"), SPEC, path("manifest"), path("clean")) == []
    assert sorted(r.id for r in read_clean(spark, SPEC, path("clean")).collect()) == [1, 2, 3, 4]


def test_a_manifest_load_that_failed_is_made_again_in_its_place(spark, path, monkeypatch):
    from tollgate.sources import files

    drop(spark, ["1;2024-01-01 10:00:00;9.0;no"], path("raw"))

    def crash(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(files, "write_clean", crash)
    with pytest.raises(OSError):
        load_unlisted(spark, path("raw"), SPEC, path("manifest"), path("clean"))
    monkeypatch.undo()
    drop(spark, ["2;2024-01-01 10:00:00;9.0;no"], path("raw"))
    assert len(load_unlisted(spark, path("raw"), SPEC, path("manifest"), path("clean"))) == 2
    rows = read_clean(spark, SPEC, path("clean"))
    assert sorted(r.id for r in rows.collect()) == [1, 2]
    assert rows.select(F.count_distinct("load_id")).first()[0] == 2
