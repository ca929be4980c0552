"""What was delivered: complete pages, and files that come again."""

import os

from strata.operators.pages import page_checks, page_islands
from strata.plans.jobs import Paths, bronze_range_job
from strata.sources import ledger, readers

COUNTS = "landing_date date, page int, record_count long"


def _counts(spark, rows):
    return spark.createDataFrame(rows, COUNTS)


def _day(d):
    import datetime
    return datetime.date(2024, 1, d)


def test_islands_and_gaps(spark):
    rows = [(_day(1), p, 5) for p in (1, 2, 5, 9)] + [(_day(2), 3, 5), (_day(2), None, 1)]
    got = sorted(map(tuple, page_islands(_counts(spark, rows)).collect()))
    assert got == [(_day(1), 1, 2, True, 2, 10), (_day(1), 3, 4, False, 2, 0), (_day(1), 5, 5, True, 1, 5),
                   (_day(1), 6, 8, False, 3, 0), (_day(1), 9, 9, True, 1, 5), (_day(2), 1, 2, False, 2, 0),
                   (_day(2), 3, 3, True, 1, 5)]
    assert page_islands(_counts(spark, [])).count() == 0


def test_page_checks(spark):
    rows = ([(_day(1), 1, 10), (_day(1), 2, 10), (_day(1), 3, 0)]  # complete, with an empty page as end mark
            + [(_day(2), 1, 10), (_day(2), 2, 4)]  # complete, the last page is not full
            + [(_day(3), 1, 10), (_day(3), 1, 10), (_day(3), 4, 10)]
            + [(_day(4), 1, 10), (_day(4), 2, 0), (_day(4), 3, 7)])
    failed = {(r.landing_date.day, r.check_name): (r.observed, r.message)
              for r in page_checks(_counts(spark, rows), 10).collect() if not r.passed}
    assert failed == {
        (3, "api_pages.missing"): (2.0, "pages missing: 2-3"),
        (3, "api_pages.repeated"): (1.0, "pages landed in several files"),
        (3, "api_pages.unfinished"): (1.0, "page 4 is full and the last one landed"),
        (4, "api_pages.after_end"): (1.0, "page 2 is empty, later ones are not")}


def test_page_counts_of_every_shape(spark, local_tmp):
    bodies = ['{"items": [{"id": 1}, {"id": [1, 2]}]}', '[{"id": 1}]', "[]", '{"items": []}', " ", '{"id": 7}', "{broken"]
    for i, body in enumerate(bodies, 1):
        with open(f"{local_tmp}/events_page_{i:04}.json", "w") as f:
            f.write(body)
    got = {r.page: r.record_count for r in readers.api_page_counts(spark, local_tmp).collect()}
    assert got == {1: 2, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1, 7: 0}


SRC = {"id": "crm", "format": "csv", "landing_subdir": "sftp/crm", "source_system_label": "crm"}


def _put(root, date, name, text):
    folder = f"{root}/sftp/crm/landing_date={date}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_digests_tell_contents_apart(spark, local_tmp):
    _put(local_tmp, "20240101", "a.csv", "id\n1\n2\n")
    _put(local_tmp, "20240101", "b.csv", "id\n1\n3\n")
    _put(local_tmp, "20240102", "c.csv", "id\n1\n2\n")
    _put(local_tmp, "20240102", "d.csv", "id\n1\n2")
    _put(local_tmp, "20240102", "e.csv", "")
    rows = {r.path.rsplit("/", 1)[1]: r.digest for r in
            ledger.file_digests(spark, [local_tmp], {"recursiveFileLookup": "true"}).collect()}
    assert set(rows) == {"a.csv", "b.csv", "c.csv", "d.csv"}
    assert rows["a.csv"] == rows["c.csv"] and len(set(rows.values())) == 3


def test_redelivered_files_are_ingested_once(spark, local_tmp):
    paths, book = Paths.under(f"{local_tmp}/lake"), f"{local_tmp}/ledger"
    text = "id,amount\n1,2\n3,4\n"
    _put(paths.landing, "20240101", "a.csv", text)
    _put(paths.landing, "20240101", "again.csv", text)
    _put(paths.landing, "20240101", "own.csv", "id,amount\n5,6\n")

    def run(start, end):
        bronze_range_job(spark, paths, start, end, "r", "now", registry=[SRC], ledger_path=book)
        return sorted((r.day, r.id) for r in spark.read.parquet(paths.bronze).collect())

    first = [(1, "1"), (1, "3"), (1, "5")]
    assert run("2024-01-01", "2024-01-01") == first
    _put(paths.landing, "20240102", "late copy.csv", text)
    _put(paths.landing, "20240102", "new.csv", "id,amount\n7,8\n")
    assert run("2024-01-02", "2024-01-02") == first + [(2, "7")]
    # Files of another header beside a copy: only those that own their contents are read.
    _put(paths.landing, "20240103", "other.csv", "amount,id\n10,9\n")
    _put(paths.landing, "20240103", "copy.csv", text)
    assert run("2024-01-02", "2024-01-03") == first + [(2, "7"), (3, "9")]
    # A rerun of everything gives the same rows, and the ledger does not grow.
    entries = ledger.read_ledger(spark, book).count()
    assert run("2024-01-01", "2024-01-03") == first + [(2, "7"), (3, "9")]
    assert ledger.read_ledger(spark, book).count() == entries == 4
