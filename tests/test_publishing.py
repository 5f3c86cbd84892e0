"""Directories that are published together or not at all, and rejects traced to their rows."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from factloom import SALES_IMPORT, run_chain, run_prep, scan, write_parquet
from factloom.plans.prep import trace_back
from factloom.sources import publishing
from factloom.sources.publishing import Storage, beside, fingerprint, note_of, publish, recover, require_one_publication
from tests.samples import GOOD, raw_sales
from tests.test_loading import Killed


def staged(spark, folder, **sizes):
    return {str(folder / n): write_parquet(spark.range(k), beside(str(folder / n), "new")) for n, k in sizes.items()}


def counts(spark, folder):
    return {p.name: scan(spark, str(p)).count() for p in sorted(Path(folder).iterdir()) if not p.name.startswith(".")}


@pytest.mark.parametrize("kill", [RuntimeError, Killed])
@pytest.mark.parametrize("step", range(7))
def test_a_failure_at_any_step_leaves_both_old_or_both_new(spark, tmp_path, monkeypatch, step, kill):
    publish(spark, staged(spark, tmp_path, a=2, b=3))
    new = staged(spark, tmp_path, a=5, b=7, c=1)
    done = []

    def failing(method):
        def run(self, *args):
            done.append(args)
            if len(done) == step + 1:  # once: what undoes it works again
                raise kill
            return method(self, *args)

        return run

    with monkeypatch.context() as patched:
        patched.setattr(Storage, "move", failing(Storage.move))
        if step == 6:
            patched.setattr(publishing, "_finish", lambda *a: (_ for _ in ()).throw(kill))
        if step < 5 or step == 6:
            with pytest.raises(kill):
                publish(spark, new)
        else:
            publish(spark, new)
    recovered = recover(spark, str(tmp_path / "a"))
    if kill is RuntimeError and step < 5:
        assert recovered is None  # undone at once
    assert counts(spark, tmp_path) == ({"a": 2, "b": 3} if step < 5 else {"a": 5, "b": 7, "c": 1})
    assert recover(spark, str(tmp_path / "a")) is None
    assert not [p for p in tmp_path.iterdir() if "publishing" in p.name or "old_" in p.name]
    publish(spark, staged(spark, tmp_path, a=1, b=1))
    require_one_publication(spark, str(tmp_path / "a"), str(tmp_path / "b"))


def test_a_plan_that_was_not_written_whole_counts_for_nothing(spark, tmp_path):
    publish(spark, staged(spark, tmp_path, a=2))
    journal = Path(publishing._journal(str(tmp_path / "a")))
    journal.mkdir()
    (journal / "plan.json").write_text('{"moves": [{"tar')
    assert recover(spark, str(tmp_path / "a")) == "undone" and counts(spark, tmp_path) == {"a": 2}


def test_directories_of_different_publications_are_told_apart(spark, tmp_path):
    publish(spark, staged(spark, tmp_path, a=2, b=3))
    publish(spark, staged(spark, tmp_path, b=4))
    with pytest.raises(ValueError, match="not of one publication"):
        require_one_publication(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    write_parquet(spark.range(1), str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not of one publication"):
        require_one_publication(spark, str(tmp_path / "plain"))


def test_fingerprints(spark, tmp_path, monkeypatch):
    target = write_parquet(spark.range(0, 100, 1, 4), str(tmp_path / "t"))
    both = []
    for few in (64, 0):  # listed by the driver, or in tasks
        monkeypatch.setattr(publishing, "FEW", few)
        before, kept = fingerprint(spark, target), fingerprint(spark, target, moved=True)
        assert fingerprint(spark, target) == before
        other = str(tmp_path / f"u{few}")
        Storage(spark).move(target, other)
        assert fingerprint(spark, other, moved=True) == kept and fingerprint(spark, other) != before
        Storage(spark).move(other, target)
        both.append(before)
    assert both[0] != both[1]
    one = next(Path(target).glob("part-*"))
    one.write_bytes(one.read_bytes() + b"x")
    assert fingerprint(spark, target) != both[1]
    assert fingerprint(spark, write_parquet(spark.range(0), str(tmp_path / "empty"))).split(":")[0] in ("0", "1")


@pytest.mark.parametrize("rejects", ["t", "", "t/inner", ".t__judged", ".t__writing"])
def test_outputs_that_overlap_are_refused_before_anything_is_written(spark, tmp_path, rejects):
    source = write_parquet(raw_sales(spark, {}, {"Quantity": "many"}), str(tmp_path / "s" / "in"))
    out = tmp_path / "out"
    target = run_prep(spark, source, str(out / "t"))
    before = sorted(p.name for p in (out / "t").iterdir())
    with pytest.raises(ValueError, match="overlap"):
        run_prep(spark, source, target, declared=SALES_IMPORT, rejects=str(out / rejects))
    assert sorted(p.name for p in (out / "t").iterdir()) == before and [p.name for p in out.iterdir()] == ["t"]


@pytest.mark.parametrize("places", [{"rejected_location": "prepared"}, {"prepared_location": "export"}, {"rejected_location": "prepared/x"}, {"export_location": ""}])
def test_a_chain_whose_steps_overlap_is_refused(spark, schema, tmp_path, places):
    raw_sales(spark, {"Quantity": "many"}).write.saveAsTable(f"{schema}.fact")
    with pytest.raises(ValueError, match="overlap"):
        run_chain(spark, f"{schema}.fact", str(tmp_path / "b"), f"{schema}.done", on_violation="split", **places)
    assert not spark.catalog.tableExists(f"{schema}.done") and not (tmp_path / "b").exists()


def test_a_source_beside_the_outputs_own_directories_is_refused(spark, tmp_path):
    source = write_parquet(raw_sales(spark), str(tmp_path / ".t__writing"))
    with pytest.raises(ValueError, match="overlap"):
        run_prep(spark, source, str(tmp_path / "t"))
    assert scan(spark, source).count() == 1


@pytest.mark.parametrize("kill", [RuntimeError, Killed])
def test_accepted_and_rejected_change_together(spark, tmp_path, monkeypatch, kill):
    good, bad = (write_parquet(raw_sales(spark, *c), str(tmp_path / n)) for n, c in (("g", [{}, {"Quantity": "x"}]), ("b", [{}, {}, {"Quantity": "x"}, {"City Key": "x"}])))
    target, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    run_prep(spark, good, target, declared=SALES_IMPORT, rejects=rejects)
    assert note_of(spark, target)["id"] == require_one_publication(spark, target, rejects)
    moves, move = [], Storage.move
    with monkeypatch.context() as patched:

        def third_fails(self, *args):
            moves.append(args)
            if len(moves) == 3:
                raise kill
            return move(self, *args)

        patched.setattr(Storage, "move", third_fails)
        with pytest.raises(kill):
            run_prep(spark, bad, target, declared=SALES_IMPORT, rejects=rejects)
    recover(spark, target)
    assert [scan(spark, p).count() for p in (target, rejects)] == [1, 1]
    run_prep(spark, bad, target, declared=SALES_IMPORT, rejects=rejects)
    assert [scan(spark, p).count() for p in (target, rejects)] == [2, 2]


@pytest.mark.parametrize("limit", [500_000, 0])
def test_rejects_are_traced_to_their_rows(spark, tmp_path, monkeypatch, limit):
    from factloom.plans import prep as module

    monkeypatch.setattr(module, "BROADCAST_REJECTS", limit)
    changes = [{"Sale Key": str(n), "Quantity": "many" if n % 3 == 0 else "1", "Package": "P" * 60 if n % 5 == 0 else "Each"} for n in range(40)]
    changes += changes[:20]  # equal rows are told apart by their place
    source = write_parquet(raw_sales(spark, *changes).repartition(3), str(tmp_path / "s"))
    target, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    run_prep(spark, source, target, declared=SALES_IMPORT, rejects=rejects, trace=True)
    rejected = scan(spark, rejects)
    found = trace_back(spark, source, rejected)
    expected = sorted((c["Sale Key"], c["Quantity"], ",".join(v for v, b in (("Package_too_long", len(c["Package"]) > 50), ("Quantity_nulls", c["Quantity"] == "many")) if b)) for c in changes if c["Quantity"] == "many" or len(c["Package"]) > 50)
    assert sorted((r["Sale Key"], r["Quantity"], r["violations"]) for r in found.collect()) == expected
    assert found.select("source_file", "source_row").distinct().count() == len(expected) == rejected.count()
    assert set(GOOD) < set(found.columns)
    assert scan(spark, target).where("source_file IS NOT NULL OR source_row IS NOT NULL").count() == 0


@pytest.mark.parametrize("most", [16_384, 0])
def test_only_marked_rows_are_shuffled_to_many_rejects(spark, tmp_path, monkeypatch, most):
    from factloom.plans import prep as module

    monkeypatch.setattr(module, "BROADCAST_REJECTS", 0)
    monkeypatch.setattr(module, "BROADCAST_MARKS", most, raising=False)
    spark.range(0, 70_000, 1, 1).withColumn("marked_bits", F.lit("mine")).write.parquet(source := str(tmp_path / "s"))
    wanted = [0, 1, 7, 8, 32_766, 32_767, 32_768, 32_769, 65_535, 65_536, 69_999]
    at = scan(spark, source).select(F.col("_metadata.file_path").alias("source_file")).first()[0]
    # one that is there twice, rows and files that no source has, and nulls
    rows = [(at, n, "a") for n in wanted] + [(at, 8, "b"), (at, 70_000, "c"), (at, -1, "c"), ("file:/none", 3, "c"), (at, None, "c"), (None, 4, "c")]
    found = trace_back(spark, source, spark.createDataFrame(rows, "source_file string, source_row long, violations string"))
    assert sorted((r.id, r.marked_bits, r.violations) for r in found.collect()) == sorted([(n, "mine", "a") for n in wanted] + [(8, "mine", "b")])
    assert ("LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()) == (most > 0)


def test_two_kinds_of_rows_need_two_files_and_no_sort(spark, tmp_path):
    from factloom.plans.compiling import writers_side_by_side

    # Spark sorts from the moment on that as many files are open as the setting allows
    with writers_side_by_side(spark, 2):
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 2


def test_what_cannot_be_traced_is_refused(spark, tmp_path):
    source = write_parquet(raw_sales(spark).withColumn("source_row", F.lit(1)), str(tmp_path / "s"))
    options = {"declared": SALES_IMPORT, "rejects": str(tmp_path / "r"), "trace": True}
    with pytest.raises(ValueError, match="distinct"):
        run_prep(spark, source, str(tmp_path / "t"), **options)
    with pytest.raises(ValueError, match="traced"):
        run_prep(spark, source, str(tmp_path / "t"), fmt="csv", **options)
    with pytest.raises(ValueError, match="traced"):
        run_prep(spark, source, str(tmp_path / "t"), trace=True)
