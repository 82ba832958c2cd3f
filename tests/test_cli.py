"""The command line: batch load of receipt files, then the checks."""

from tests.conftest import SMOKE_DIR
from tillflow import fixtures
from tillflow.__main__ import main
from tillflow.operators.load import targets
from tillflow.operators.normalize import normalize
from tillflow.sinks.csv import write_csv


def test_batch_then_check(spark, scratch, capsys):
    inbox, base = scratch("inbox"), scratch("targets")
    write_csv(fixtures.receipts(spark, SMOKE_DIR), f"{inbox}/day1")
    main(["batch", "--source", f"{inbox}/*", "--targets", base])
    main(["batch", "--source", f"{inbox}/*", "--targets", base])  # replay: nothing new
    loaded = targets(spark, base)["orders_products"]
    expected = normalize(fixtures.receipts(spark, SMOKE_DIR)).orders_products
    assert loaded.exceptAll(expected).count() == 0 and expected.exceptAll(loaded).count() == 0
    main(["check", "--targets", base])
    out = capsys.readouterr().out
    assert "n_dup_keys" in out and "n_orphans" in out


def test_processed_outputs_and_rejects(spark, scratch, capsys):
    inbox, out, base = scratch("inbox"), scratch("processed"), scratch("targets")
    write_csv(fixtures.receipts(spark, SMOKE_DIR), f"{inbox}/day1")
    main(["write-processed", "--source", f"{inbox}/*", "--out", out, "--name", "in/day1.csv"])
    main(["load", "--processed", out, "--targets", base])
    main(["compact", "--targets", base])
    loaded = targets(spark, base)["orders_products"]
    expected = normalize(fixtures.receipts(spark, SMOKE_DIR)).orders_products
    assert loaded.exceptAll(expected).count() == 0 and expected.exceptAll(loaded).count() == 0
    bad = scratch("inbox")
    fixtures.faulty_lines(spark, SMOKE_DIR).write.text(f"{bad}/day2")
    landing = scratch("landing")
    main(["batch", "--source", f"{bad}/*", "--targets", base, "--landing", landing])
    main(["rejects", "--targets", base])
    said = capsys.readouterr().out
    assert "wrong number of fields" in said and "price not a number" in said and "receipt_rejects" in said
    assert spark.read.parquet(landing).count() == fixtures.receipts(spark, SMOKE_DIR).count()


def test_batch_with_shake_ids(spark, scratch):
    inbox, base = scratch("inbox"), scratch("targets")
    write_csv(fixtures.receipts(spark, SMOKE_DIR), f"{inbox}/day1")
    main(["batch", "--source", f"{inbox}/*", "--targets", base, "--id-hash", "shake256"])
    t = targets(spark, base)
    assert {len(r.order_id) for r in t["orders"].select("order_id").distinct().collect()} == {16}
    assert {len(r.store_id) for r in t["stores"].collect()} == {10}
