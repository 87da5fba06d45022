from __future__ import annotations

import pytest

from ledgerflow.layout import PAYMENT_COLUMNS
from ledgerflow.plans.bronze import gate_report
from ledgerflow.sources.deliveries import HEADER_ID, Landing, discover, parse_header, read_deliveries, read_landing
from payments import payment, write_csv


def test_discovery_is_sorted_flat_and_filtered(spark, tmp_path):
    for name in ("b.csv", "a.csv", "sub/c.csv", "note.txt"):
        write_csv(tmp_path / name, [payment()])
    (tmp_path / "empty.csv").touch()
    landing = Landing(str(tmp_path))
    assert discover(spark, landing) == ["a.csv", "b.csv", "empty.csv"]
    assert discover(spark, Landing(str(tmp_path), pattern="b*")) == ["b.csv"]


def test_missing_folder_has_no_deliveries(spark, tmp_path):
    landing = Landing(str(tmp_path / "none"))
    assert discover(spark, landing) == [] and read_landing(spark, landing).headers == []


def test_folders_as_deliveries(spark, tmp_path):
    for name in ("day1/part-0.csv", "day1/part-1.csv", "day2/part-0.csv"):
        write_csv(tmp_path / name, [payment()])
    rows = read_deliveries(spark, Landing(str(tmp_path), unit="folder"))
    assert {r[0]: r[1] for r in rows.groupBy("source_file").count().collect()} == {"day1": 2, "day2": 1}


def test_folders_of_one_name_are_two_deliveries(spark, tmp_path):
    write_csv(tmp_path / "eu/day1/part-0.csv", [payment("E1")])
    (tmp_path / "us/day1").mkdir(parents=True)
    header = ",".join(PAYMENT_COLUMNS)
    (tmp_path / "us/day1/part-0.csv").write_text(f"{header}\n{','.join(payment('U1').values())},more\n")
    rows = read_deliveries(spark, Landing(str(tmp_path), unit="folder")).select("source_file", "transaction_id").collect()
    assert [tuple(r) for r in rows] == [("eu/day1", "E1")]


def test_a_file_that_arrives_during_a_run_waits(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "a.csv", [payment("T1")])
    from ledgerflow.sources import deliveries

    whole = deliveries.parsed

    def late(*arguments):
        write_csv(tmp_path / "b.csv", [payment("T2")], list(reversed(PAYMENT_COLUMNS)))
        return whole(*arguments)

    monkeypatch.setattr(deliveries, "parsed", late)
    landing = Landing(str(tmp_path))
    rows = read_deliveries(spark, landing).select("transaction_id", "merchant_id", "source_file").collect()
    assert [tuple(r) for r in rows] == [("T1", "M1", "a.csv")]
    monkeypatch.undo()
    rows = read_deliveries(spark, landing).select("transaction_id", "merchant_id", "source_file").collect()
    assert sorted(tuple(r) for r in rows) == [("T1", "M1", "a.csv"), ("T2", "M1", "b.csv")]


def test_headers_are_read_alone_and_rows_are_never_stored(spark, tmp_path, monkeypatch):
    from ledgerflow.sources import deliveries

    calls = []
    whole = deliveries.parsed
    monkeypatch.setattr(deliveries, "parsed", lambda *a: calls.append(1) or whole(*a))
    write_csv(tmp_path / "a.csv", [payment("T1")])
    write_csv(tmp_path / "b.csv", [payment("T2")], list(reversed(PAYMENT_COLUMNS)))
    found = read_landing(spark, Landing(str(tmp_path)))
    assert len(found.headers) == 2 and not calls
    assert found.rows().count() == 2 and len(calls) == 1
    assert all(path.endswith(".csv") or "described-files" in path for path in found.rows().inputFiles())


def test_the_rest_of_a_large_file_is_not_read_for_its_header():
    import pyarrow as pa

    from ledgerflow.sources import deliveries

    read = []

    def batches():
        for n in range(10_000):
            read.append(n)
            yield pa.record_batch({"path": ["/a.csv"] * 2, "value": ["", "a,b,,"] if n == 1 else ["", ""]})

    (found,) = deliveries.first_lines(False)(batches())
    assert found.to_pylist() == [{"path": "/a.csv", "text": '["a", "b"]'}]
    assert len(read) <= 2 + deliveries.HEAD_BATCHES + 1


def test_header_fields():
    from ledgerflow.sources.deliveries import header_fields

    assert header_fields(iter(["", "  ", 'a,"b ""x"", c",,', "1,2"])) == ["a", 'b "x", c']
    assert header_fields(iter(['a,"two', 'lines",c', "1,2,3"])) == ["a", "two\nlines", "c"]
    assert header_fields(iter([])) is None and header_fields(iter([",,"])) == []


def test_headers_wider_than_the_scan(spark, tmp_path):
    columns = [f"c{i}" for i in range(70)]
    write_csv(tmp_path / "wide.csv", [{c: c.upper() for c in columns}], columns)
    (row,) = read_deliveries(spark, Landing(str(tmp_path))).collect()
    assert row["c69"] == "C69"


def test_reserved_names_are_refused_and_others_are_kept(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [payment("T1", fate="x", rejected_text="y")], [*PAYMENT_COLUMNS, "fate", "rejected_text"])
    (row,) = read_deliveries(spark, Landing(str(tmp_path))).collect()
    assert (row["fate"], row["rejected_text"]) == ("x", "y")
    write_csv(tmp_path / "b.csv", [payment("T1") | {HEADER_ID: "z"}], [*PAYMENT_COLUMNS, HEADER_ID])
    with pytest.raises(ValueError, match="reserved"):
        read_landing(spark, Landing(str(tmp_path)))


def test_unit_is_checked():
    with pytest.raises(ValueError, match="unit"):
        Landing("x", unit="table")


def test_everything_stays_text(spark, tmp_path):
    row = payment("007", amount=" 1,5 ", card_last4="", customer_email='a "b", c', gateway_ref="N/A")
    write_csv(tmp_path / "a.csv", [row])
    (read,) = read_deliveries(spark, Landing(str(tmp_path))).collect()
    assert {c: read[c] for c in PAYMENT_COLUMNS} == row


def test_short_rows_are_padded_and_long_rows_disqualify_the_delivery(spark, tmp_path):
    (tmp_path / "short.csv").write_text("a,b,c\n1,2\n3,4,5\n")
    (tmp_path / "long.csv").write_text("a,b,c\n1,2,3\n4,5,6,7\n")
    rows = read_deliveries(spark, Landing(str(tmp_path)))
    assert sorted((r["a"], r["b"], r["c"], r["source_file"]) for r in rows.collect()) == [
        ("1", "2", "", "short.csv"),
        ("3", "4", "5", "short.csv"),
    ]


def test_columns_are_matched_by_name_across_headers(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [payment("T1")])
    write_csv(tmp_path / "b.csv", [payment("T2", payment_network="VISA")], ["payment_network", *reversed(PAYMENT_COLUMNS)])
    rows = {r["transaction_id"]: r for r in read_deliveries(spark, Landing(str(tmp_path))).collect()}
    assert rows["T1"]["amount"] == rows["T2"]["amount"] == "100.00"
    assert (rows["T1"]["payment_network"], rows["T2"]["payment_network"]) == (None, "VISA")


def test_awkward_names(spark, tmp_path):
    for name in ("two words.csv", "50%25.csv", "a+b.csv", "k=v.csv", "ü.csv", "pay[1].csv", "a{b}.csv", "s*r.csv"):
        write_csv(tmp_path / name, [payment(name)])
    write_csv(tmp_path / "other.csv", [payment("other.csv")], [*PAYMENT_COLUMNS, "device.id"])
    rows = read_deliveries(spark, Landing(str(tmp_path))).select("source_file", "transaction_id").collect()
    assert len(rows) == 9 and all(r[0] == r[1] for r in rows)


def test_header_lines():
    assert parse_header(["\ufeffa", "b, c", "a", "A", None]) == ["a", "b, c", "a.1", "A.2", ""]


def test_blank_lines_before_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\na,b\n1,2\n")
    (row,) = read_deliveries(spark, Landing(str(tmp_path))).collect()
    assert (row["a"], row["b"]) == ("1", "2")


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n"one\ntwo",2\n')
    (row,) = read_deliveries(spark, Landing(str(tmp_path), multi_line=True)).collect()
    assert (row["a"], row["b"]) == ("one\ntwo", "2")


def test_promised_header_is_checked_by_the_scan(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [payment()])
    landing = Landing(str(tmp_path))
    assert read_deliveries(spark, landing, PAYMENT_COLUMNS).count() == 1
    write_csv(tmp_path / "b.csv", [payment()], list(reversed(PAYMENT_COLUMNS)))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_deliveries(spark, landing, PAYMENT_COLUMNS).collect()


def test_gate_names_every_missing_column(spark, tmp_path):
    write_csv(tmp_path / "good.csv", [payment()], [*PAYMENT_COLUMNS, "device"])
    write_csv(tmp_path / "bad.csv", [payment()] * 2, [c for c in PAYMENT_COLUMNS if c not in ("amount", "status")])
    landing = Landing(str(tmp_path))
    rows = gate_report(read_landing(spark, landing), PAYMENT_COLUMNS).collect()
    assert {r["source_file"]: (r["passed"], r["missing_columns"], r["extra_columns"], r["rows"]) for r in rows} == {
        "good.csv": (True, "", "device", 1),
        "bad.csv": (False, "amount,status", "", 2),
    }
