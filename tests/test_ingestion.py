import json
from datetime import datetime

import pytest

from loanmill import schemas
from loanmill.sources import feeds, files
from loanmill.sources.feeds import Landed, Landing, Source, ingest, missing_columns
from loanmill.streaming.landing import land_new_files, stream_rows

HEADER = ",".join(schemas.SOURCE_COLUMNS)
ROW = (
    "A-1,2024-01-01,P-1,85000,250000,310000,Conventional,6.25,360,0.32,0.81,TX,Travis County,First Lender,Approved,,"
    "700-739,CORE,2024-01-01,2024-01-05"
)
NOW, LATER = datetime(2024, 6, 1), datetime(2024, 6, 2)


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def csv_source(folder):
    return Source("core", "csv", f"{folder}/core*.csv")


def json_source(folder, **more):
    return Source("broker", "json", f"{folder}/broker*.json", **more)


def test_schema_check():
    assert missing_columns(schemas.SOURCE_COLUMNS) == []
    fewer = [c for c in schemas.SOURCE_COLUMNS if c not in ("loan_amount", "interest_rate")]
    assert set(missing_columns([*fewer, "extra"])) == {"loan_amount", "interest_rate"}


def landed(spark, tmp_path, *sources):
    landing = Landing(spark, f"{tmp_path}/bronze")
    return landing, ingest(spark, sources, landing, NOW)


def test_csv_cells_stay_text(spark, tmp_path):
    write(tmp_path, "core.csv", f"{HEADER}\n{ROW.replace('250000', chr(34) + '$231,649.84' + chr(34))}\n")
    landing, tally = landed(spark, tmp_path, csv_source(tmp_path))
    row = landing.bronze().first()
    assert (row["loan_amount"], row["denial_reason"], row["_source_file"], tally) == ("$231,649.84", "", "core.csv", Landed(1, 0, 0))


def test_csv_columns_are_read_by_name_and_may_span_lines(spark, tmp_path):
    names = list(reversed(schemas.SOURCE_COLUMNS)) + ["extra", "lender"]
    values = list(reversed(ROW.split(","))) + ["more", "second lender"]
    values[names.index("lender")] = '"First\nLender, ""Inc"""'
    write(tmp_path, "core_a.csv", f"{','.join(names)}\n{','.join(values)}\n")
    write(tmp_path, "core_b.csv", f"\ufeff{HEADER}\n{ROW}\n")
    write(tmp_path, "core_c.csv", f"application_id,lender\nA-9,x\n")
    write(tmp_path, "core_d.csv", "")
    write(tmp_path, "core_e.csv", f"{HEADER},later\n{ROW.replace('A-1', 'A-2')},z\n{ROW.replace('A-1', '')}\n")
    landing, tally = landed(spark, tmp_path, csv_source(tmp_path))
    assert sorted((r["application_id"], r["lender"]) for r in landing.bronze().collect()) == [
        ("A-1", 'First\nLender, "Inc"'), ("A-1", "First Lender"), ("A-2", "First Lender")
    ]
    assert sorted(tuple(r) for r in landing.counts().collect()) == [("core_a.csv", 1, 0), ("core_b.csv", 1, 0), ("core_e.csv", 1, 1)]
    assert tally == Landed(3, 1, 1)


def test_first_file_without_a_usable_header(spark, tmp_path):
    write(tmp_path, "core_a.csv", "lender,x\n1,2\n")
    write(tmp_path, "core_b.csv", f"{HEADER}\n{ROW}\n")
    landing, tally = landed(spark, tmp_path, csv_source(tmp_path))
    assert tally == Landed(1, 0, 1) and landing.bronze().first()["application_id"] == "A-1"


def test_json_keeps_number_text_and_null(spark, tmp_path):
    base = dict(zip(schemas.SOURCE_COLUMNS, ROW.split(",")))
    records = [{**base, "loan_amount": 250000.0, "denial_reason": None}, {**base, "application_id": "A-2", "loan_amount": "$99,000.00"}]
    write(tmp_path, "broker.json", json.dumps(records))
    write(tmp_path, "broker_bad.json", json.dumps([{"application_id": "A-3"}]))
    landing, tally = landed(spark, tmp_path, json_source(tmp_path))
    rows = landing.bronze().orderBy("application_id").collect()
    assert [(r["loan_amount"], r["denial_reason"]) for r in rows] == [("250000.0", None), ("$99,000.00", "")]
    assert tally == Landed(2, 0, 1)
    lines = tmp_path / "lines"
    write(lines, "broker.json", "\n".join(json.dumps(r) for r in records))
    write(lines, "broker_bad.json", json.dumps({"application_id": "A-3", "lender": {"nested": 1}}))
    landing, tally = landed(spark, lines, json_source(lines, one_record_per_line=True))
    assert landing.bronze().count() == 2 and tally == Landed(2, 0, 1)


def test_json_columns_that_are_always_null_or_sometimes_absent(spark, tmp_path):
    base = dict(zip(schemas.SOURCE_COLUMNS, ROW.split(",")))
    short = {k: v for k, v in base.items() if k != "denial_reason"}
    write(tmp_path, "broker_a.json", json.dumps([short, base]))
    write(tmp_path, "broker_b.json", json.dumps([short, {**base, "denial_reason": None}]))
    write(tmp_path, "broker_c.json", json.dumps([short, short]))
    landing, tally = landed(spark, tmp_path, json_source(tmp_path))
    assert sorted(r["_source_file"] for r in landing.bronze().collect()) == ["broker_a.json"] * 2 + ["broker_b.json"] * 2
    assert tally == Landed(4, 0, 1)


def test_missing_source_is_skipped(spark, tmp_path):
    landing, tally = landed(spark, tmp_path, csv_source(tmp_path / "nowhere"))
    assert tally == Landed(0, 0, 0) and landing.counts().count() == 0


def test_many_files_cost_a_bounded_number_of_driver_reads(spark, tmp_path, monkeypatch):
    raw, calls = tmp_path / "raw", []
    for k in range(300):
        write(raw, f"core_{k:03d}.csv", f"{HEADER}\n{ROW.replace('A-1', f'A-{k}')}\n")
    for name in ("head", "glob", "read_text"):
        monkeypatch.setattr(files, name, lambda *a, f=getattr(files, name), name=name: calls.append(name) or f(*a))
    source = Source("core", "csv", f"{raw}/core*.csv", one_record_per_line=True)
    landing, tally = landed(spark, tmp_path, source)
    assert tally == Landed(300, 0, 0) and calls.count("head") == 1 and len(calls) < 12
    ingest(spark, [source], landing, LATER)
    assert calls.count("head") == 2 and len(calls) < 24
    assert len(list((tmp_path / "bronze").iterdir())) < 5  # no folder per file
    assert landing.bronze().count() == 300 and {r["_ingestion_timestamp"] for r in landing.bronze().collect()} == {LATER}


def test_rows_without_id_are_quarantined(spark, tmp_path):
    write(tmp_path / "raw", "core.csv", f"{HEADER}\n{ROW}\n{ROW.replace('A-1', '', 1)}\n{ROW.replace('A-1', '  ', 1)}\n")
    landing = Landing(spark, f"{tmp_path}/bronze")
    ingest(spark, [csv_source(tmp_path / "raw")], landing, NOW)
    assert (landing.bronze().count(), landing.quarantine().count()) == (1, 2)
    assert [tuple(r) for r in landing.counts().collect()] == [("core.csv", 1, 2)]
    row = landing.bronze().first()
    assert (row["_source_file"], row["_ingestion_timestamp"]) == ("core.csv", NOW)


def test_loading_a_file_again_replaces_it(spark, tmp_path):
    raw, landing = tmp_path / "raw", Landing(spark, f"{tmp_path}/bronze")
    write(raw, "core_1.csv", f"{HEADER}\n{ROW}\n")
    write(raw, "core_2.csv", f"{HEADER}\n{ROW.replace('A-1', 'A-2')}\n{ROW.replace('A-1', '', 1)}\n")
    ingest(spark, [csv_source(raw)], landing, NOW)
    ingest(spark, [csv_source(raw)], landing, LATER)
    assert landing.bronze().count() == 2 and landing.quarantine().count() == 1
    # The first file comes again without any valid row, the second without a malformed one.
    write(raw, "core_1.csv", f"{HEADER}\n")
    write(raw, "core_2.csv", f"{HEADER}\n{ROW.replace('A-1', 'A-3')}\n")
    ingest(spark, [csv_source(raw)], landing, datetime(2024, 6, 3))
    assert [r["application_id"] for r in landing.bronze().collect()] == ["A-3"]
    assert landing.quarantine().count() == 0


def test_files_of_one_name_in_two_folders_are_two_files(spark, tmp_path):
    source, landing = Source("core", "csv", f"{tmp_path}/d*/core.csv"), Landing(spark, f"{tmp_path}/bronze")
    for folder, key in (("d1", "A-1"), ("d2 +x", "A-2")):
        write(tmp_path / folder, "core.csv", f"{HEADER}\n{ROW.replace('A-1', key)}\n")
        ingest(spark, [source], landing, NOW)
    rows = {("A-1", "d1/core.csv"), ("A-2", "d2 +x/core.csv")}
    assert {(r["application_id"], r["_source_file"]) for r in landing.bronze().collect()} == rows
    # A widened pattern: the files are known by their paths.
    write(tmp_path / "d2 +x", "core_2.csv", f"{HEADER}\n{ROW.replace('A-1', 'A-3')}\n")
    ingest(spark, [Source("core", "csv", f"{tmp_path}/d*/core*.csv")], landing, LATER)
    assert sorted(r["application_id"] for r in landing.bronze().collect()) == ["A-1", "A-2", "A-3"]


def test_files_of_one_name_in_two_sources_are_two_files(spark, tmp_path):
    landing, sources = Landing(spark, f"{tmp_path}/bronze"), []
    for name, key in (("one", "A-1"), ("two", "A-2")):
        write(tmp_path / name, "core.csv", f"{HEADER}\n{ROW.replace('A-1', key)}\n")
        sources.append(Source(name, "csv", f"{tmp_path}/{name}/core.csv"))
    assert ingest(spark, sources, landing, NOW) == Landed(2, 0, 0)
    assert [tuple(r) for r in landing.counts().collect()] == [("core.csv", 2, 0)]


def test_a_file_that_loses_its_columns_keeps_what_was_landed(spark, tmp_path):
    raw, landing = tmp_path / "raw", Landing(spark, f"{tmp_path}/bronze")
    write(raw, "core_1.csv", f"{HEADER}\n{ROW}\n")
    write(raw, "core_2.csv", f"{HEADER}\n{ROW.replace('A-1', 'A-2')}\n")
    ingest(spark, [csv_source(raw)], landing, NOW)
    write(raw, "core_2.csv", "application_id\nA-7\n")
    assert ingest(spark, [csv_source(raw)], landing, LATER) == Landed(1, 0, 1)
    assert {(r["application_id"], r["_ingestion_timestamp"]) for r in landing.bronze().collect()} == {("A-1", LATER), ("A-2", NOW)}


def test_a_failed_load_changes_nothing_and_leaves_nothing(spark, tmp_path, monkeypatch):
    raw, landing = tmp_path / "raw", Landing(spark, f"{tmp_path}/bronze")
    write(raw, "core_1.csv", f"{HEADER}\n{ROW}\n")
    ingest(spark, [csv_source(raw)], landing, NOW)
    write(raw, "core_1.csv", f"{HEADER}\n{ROW.replace('A-1', 'A-2')}\n")

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(feeds.files, "write_text", broken)
        with pytest.raises(OSError):
            ingest(spark, [csv_source(raw)], landing, LATER)
    assert [r["application_id"] for r in landing.bronze().collect()] == ["A-1"]
    ingest(spark, [csv_source(raw)], landing, LATER)
    assert [r["application_id"] for r in landing.bronze().collect()] == ["A-2"]
    assert len(list((tmp_path / "bronze" / "rows").glob("batch=*"))) == 2  # the current one and the one before
    ingest(spark, [csv_source(raw)], landing, LATER)
    assert len(list((tmp_path / "bronze" / "manifest").iterdir())) == 2


def test_a_repeated_load_of_the_same_time_leaves_nothing_stale(spark, tmp_path):
    landing = Landing(spark, f"{tmp_path}/bronze")
    for row in (ROW, ROW.replace("A-1", " ", 1)):
        write(tmp_path, "core.csv", f"{HEADER}\n{row}\n")
        ingest(spark, [csv_source(tmp_path)], landing, NOW)
    assert (landing.bronze().count(), landing.quarantine().count()) == (0, 1)


def test_stream_lands_only_new_files(spark, tmp_path):
    raw, landing = tmp_path / "raw", Landing(spark, f"{tmp_path}/bronze")
    write(raw, "core_1.csv", f"{HEADER}\n{ROW}\n")

    def run(now):
        land_new_files(stream_rows(spark, "csv", str(raw)), landing, f"{tmp_path}/progress", now).awaitTermination()

    run(NOW)
    write(raw, "core_2.csv", f"{HEADER}\n{ROW.replace('A-1', 'A-2')}\n{ROW.replace('A-1', '', 1)}\n")
    run(LATER)
    assert sorted((r["application_id"], r["_ingestion_timestamp"]) for r in landing.bronze().collect()) == [("A-1", NOW), ("A-2", LATER)]
    assert landing.quarantine().count() == 1
