from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.operators import runlog, snapshots, transactions
from ledgermill.sources import files, messages, statements
from tests.rows import core, values
from ledgermill import schemas

BANK = (
    "Date,Amount,Account Number,Transaction Type,Transaction Details,Balance,Category,Merchant Name,Processed On\n"
    '4 Mar 26,-12.50,1,DEBIT,"Coffee, two cups",100.00,Food,Cafe,5 Mar 26\n'
    "\n"
    "24 Mar 26,2000.00,1,CREDIT,Salary,2100.00,,,\n"
)
SPLIT = "Date,Debit,Credit,Description,Balance\r\n24/03/2026,10.00,,Rates,5.00\r\n25/03/2026,,7.00,Refund,12.00\r\n"


@pytest.fixture()
def statement_folder(folder):
    for name, body in (("export.csv", BANK), ("bendigo-march.csv", SPLIT), ("commsec.csv", SPLIT),
                       ("unknown.csv", "a,b\n1,2\n")):
        with open(os.path.join(folder, name), "w", newline="") as handle:
            handle.write(body)
    return folder


@pytest.mark.parametrize("block", ["128m", "16"])
def test_statements_by_header_and_by_name(spark, statement_folder, block):
    """A file gives the same rows whether it is split or not."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        check_statements(spark, statement_folder)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def check_statements(spark, statement_folder):
    rows = statements.read_statement(spark, statement_folder, F.lit(1))
    name = F.substring_index("source_file", "/", -1)
    found = values(rows.withColumn("f", name), "f", "provider", "row_num", "txn_date_raw",
                   "amount_raw", "debit_raw", "credit_raw", "description_raw")
    assert found == [
        ("bendigo-march.csv", "Bendigo", 1, "24/03/2026", None, "10.00", None, "Rates"),
        ("bendigo-march.csv", "Bendigo", 2, "25/03/2026", None, None, "7.00", "Refund"),
        ("commsec.csv", "CommSec", 1, "24/03/2026", None, "10.00", None, "Rates"),
        ("commsec.csv", "CommSec", 2, "25/03/2026", None, None, "7.00", "Refund"),
        ("export.csv", "NAB", 1, "4 Mar 26", "-12.50", None, None, "Coffee, two cups"),
        ("export.csv", "NAB", 3, "24 Mar 26", "2000.00", None, None, "Salary"),
        ("unknown.csv", None, 1, None, None, None, None, None),
    ]
    extra = json.loads(rows.filter("row_num = 1 AND provider = 'NAB'").first().raw_json)
    assert extra["Merchant Name"] == "Cafe" and "Amount" not in extra


def test_split_files_number_lines_across_blocks(spark, folder):
    body = "Date,Amount,Transaction Details,Balance\n" + "".join(
        f"4 Mar 26,{i}.00,row {i},0\n" for i in range(1, 3001))
    with open(os.path.join(folder, "nab.csv"), "w") as handle:
        handle.write(body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = statements.read_statement(spark, folder, F.lit(1)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.row_num for r in rows) == list(range(1, 3001))
    assert all(r.description_raw == f"row {r.row_num}" for r in rows)


@pytest.mark.parametrize("block", ["128m", "40"])
def test_wide_files_blank_and_repeated_headers_and_quoted_breaks(spark, folder, block):
    more = [f"x{i}" for i in range(40)]
    names = ["Date", "Amount", "Account Number", "", "Type", "Type", "Transaction Details", "Balance"]
    first = ["4 Mar 26", "-1.00", "7", "in", "a", "b", '"two\nlines, ""quoted"""', "9.00", *more]
    second = ["5 Mar 26", "-2.00", "7", "", "c", "d", "plain", "8.00", *more, "beyond"]
    with open(os.path.join(folder, "nab-wide.csv"), "w") as handle:
        handle.write("\n".join(",".join(row) for row in ([*names, *more], first, second)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = statements.read_statement(spark, folder, F.lit(1)).orderBy("row_num").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.description_raw for r in rows] == ['two\nlines, "quoted"', "plain"]
    assert [r.balance_raw for r in rows] == ["9.00", "8.00"]
    assert [r.row_num for r in rows] == [1, 3]
    extra = [json.loads(r.raw_json) for r in rows]
    assert [e.get("column_4") for e in extra] == ["in", None]
    assert [(e["Type"], e["Type#6"]) for e in extra] == [("a", "b"), ("c", "d")]
    assert extra[0]["x39"] == "x39" and extra[1]["column_49"] == "beyond"


@pytest.mark.parametrize("block", ["128m", "40"])
def test_a_quote_left_open_harms_its_own_line_only(spark, folder, block, monkeypatch):
    """The text is scanned once, and a record that is not well formed is read line by line."""
    lines = ["Date,Amount,Transaction Details,Balance"]
    lines += [f"{i} Mar 26,-{i}.00,row {i},{i}" for i in range(1, 8)]
    lines[2] = '2 Mar 26,-2.00,"TV screen,2'
    lines[5] = '5 Mar 26,-5.00,"said, ""so""",5'
    lines[7] = '7 Mar 26,-7.00,"two\nlines",7'
    with open(os.path.join(folder, "nab.csv"), "w") as handle:
        handle.write("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = statements.read_statement(spark, folder, F.lit(1))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        found = {r.row_num: r.description_raw for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert "FileScan text" not in plan and "Scan text" not in plan
    assert found == {1: "row 1", 2: None, 3: "row 3", 4: "row 4", 5: 'said, "so"', 6: "row 6",
                     7: "two\nlines"}


def test_records_beyond_the_bound_are_read_line_by_line(spark, folder, monkeypatch):
    monkeypatch.setattr(statements, "MOST_LINES", 3)
    body = "Date,Amount,Transaction Details,Balance\n"
    body += '1 Mar 26,-1.00,"a\nb\nc",1\n2 Mar 26,-2.00,"a\nb\nc\nd",2\n3 Mar 26,-3.00,x,3\n'
    with open(os.path.join(folder, "nab.csv"), "w") as handle:
        handle.write(body)
    found = statements.read_statement(spark, folder, F.lit(1))
    assert [r[0] for r in values(found, "row_num")] == [1, 4, 5, 6, 7, 8]
    assert values(found.filter("row_num IN (1, 8)"), "description_raw") == [("a\nb\nc",), ("x",)]


def test_provider_needs_a_whole_word_or_a_clear_header(spark, folder):
    for name in ("annabel.csv", "my_commsec_2024.csv", "Bendigo Bank.csv"):
        with open(os.path.join(folder, name), "w") as handle:
            handle.write("Date,Debit,Credit,Description,Balance\n24/03/2026,10.00,,Rates,5.00\n")
    rows = statements.read_statement(spark, folder, F.lit(1))
    name = F.regexp_replace(F.substring_index("source_file", "/", -1), "%20", " ")
    assert values(rows.withColumn("f", name), "f", "provider") == [
        ("Bendigo Bank.csv", "Bendigo"), ("annabel.csv", None), ("my_commsec_2024.csv", "CommSec")]


def test_rows_above_the_header_are_skipped(spark, folder):
    with open(os.path.join(folder, "x-bank.csv"), "w") as handle:
        handle.write("Report\nDate,Amount,What\n01/02/2026,5.00,a\n")
    layout = statements.Layout("x-bank", "Date", "Amount", None, None, "What", None, 1)
    rows = statements.read_statement(spark, folder, F.lit(1), layouts=(layout,))
    assert values(rows, "row_num", "amount_raw", "description_raw") == [(1, "5.00", "a")]


def test_share_trades(spark, folder):
    with open(os.path.join(folder, "trades.csv"), "w") as handle:
        handle.write("Trade Date,Security,Quantity,Price,Value,Type,Brokerage,Note\n"
                     "01/08/2024,abc,10,2.5,25.00,Buy,9.95,first\n02/08/2024,abc,4,3,12.00,Sell,,\n")
    rows = transactions.normalise_trades(statements.read_share_trades(spark, folder, F.lit(4)))
    found = values(rows, "security_code", "trade_type", "cgt_event", "fy_year")
    assert found == [("ABC", "BUY", False, 2025), ("ABC", "SELL", True, 2025)]
    buy = rows.filter("trade_type = 'BUY'").first()
    assert float(buy.cost_base) == 34.95
    assert len(buy.dedup_hash) == 64


def part(name, mime="application/pdf", size=5, parts=None, attachment="a"):
    body = {"size": size}
    if attachment:
        body["attachmentId"] = attachment
    row = {"mimeType": mime, "filename": name, "body": body}
    return {**row, "parts": parts} if parts is not None else row


def parsed(spark, payloads):
    rows = [(json.dumps({"id": f"m{i}", "internalDate": "1704067200000", "snippet": "s", "payload": p}),)
            for i, p in enumerate(payloads)]
    return messages.parse_messages(spark.createDataFrame(rows, "j STRING"), "j")


def test_pdf_parts_at_any_depth(spark):
    headers = [{"name": "SUBJECT", "value": "Bill"}, {"name": "From", "value": "Shop <a@b.c>"}]
    deep = part("", "m/x", 0, [part("", "m/x", 0, [part("deep.PDF"), part("void.pdf", size=0)])])
    payloads = [
        {**part("root.pdf"), "headers": headers},
        {**part("", "m/x", 0, [part("one.pdf"), part("note.txt"), deep, part("two.pdf")]), "headers": headers},
        {**part("", "m/x", 0, [part("", "application/PDF")]), "headers": headers},
        part("", "m/x", 0, []),
    ]
    rows = messages.flatten_messages(parsed(spark, payloads))
    assert values(rows, "source_id", "file_name", "subject", "sender_email") == [
        ("m0", "root.pdf", "Bill", "a@b.c"), ("m1", "deep.PDF", "Bill", "a@b.c"),
        ("m1", "one.pdf", "Bill", "a@b.c"), ("m1", "two.pdf", "Bill", "a@b.c"),
    ]
    kept = json.loads(rows.filter("source_id = 'm0'").first().raw_json)
    assert "body" not in kept["payload"]
    first = messages.first_pdf(parsed(spark, payloads))
    assert values(first, "source_id", "file_name", "no_attachment") == [
        ("m0", "root.pdf", False), ("m1", "one.pdf", False), ("m2", "attachment.pdf", False),
        ("m3", "attachment.pdf", True),
    ]


def nested(levels):
    inner = part("x.pdf")
    for _ in range(levels):
        inner = part("", "m/x", 0, [inner, part("note.txt")])
    return inner


def test_messages_are_read_to_any_depth(spark):
    depths = (0, 5, 6, 12, 30, 60, 150)
    rows = parsed(spark, [nested(d) for d in depths] + [part("", "text/plain")])
    found = values(messages.flatten_messages(rows), "source_id", "file_name")
    assert found == [(f"m{i}", "x.pdf") for i in range(len(depths))]
    assert values(messages.first_pdf(rows).filter("NOT no_attachment"), "source_id") == [
        (f"m{i}",) for i in range(len(depths))
    ]
    assert values(messages.body_rows(rows), "source_id") == [(f"m{len(depths)}",)]
    # Document order holds across the passes.
    parts = messages.with_parts(rows).filter("id = 'm4'").select("_parts.filename").first()[0]
    assert parts == [""] * 29 + ["x.pdf"] + ["note.txt"] * 30


def test_staging_folder(spark, folder):
    names = ["a.pdf", "b.PNG", "copy of a.pdf", ".hidden.pdf", "c.csv", "noext"]
    for name in names:
        with open(os.path.join(folder, name), "wb") as handle:
            handle.write(b"same" if name.endswith("a.pdf") else name.encode())
    os.mkdir(os.path.join(folder, "sub"))
    with open(os.path.join(folder, "sub", "deep.pdf"), "wb") as handle:
        handle.write(b"x")
    kept = files.scan_staging(spark, folder)
    assert values(kept, "file_name", "file_ext") == [
        ("a.pdf", "pdf"), ("b.PNG", "png"), ("copy of a.pdf", "pdf"),
    ]
    assert kept.select("file_hash").distinct().count() == 2
    assert values(files.unsupported_files(spark, folder), "file_ext", "files") == [
        ("csv", 1), (None, 1),
    ]


def test_files_are_hashed_in_chunks_and_dealt_by_size(spark, folder):
    import hashlib

    bodies = {"a b%20c.pdf": b"x" * 100_000, "empty.pdf": b"", "z+z.PNG": bytes(range(256)) * 9, "n.txt": b"no"}
    for name, body in bodies.items():
        with open(os.path.join(folder, name), "wb") as handle:
            handle.write(body)
    for path in (folder, f"file://{folder}"):
        for chunk in (7, 1 << 20):
            rows = files.scan_staging(spark, path, chunk_bytes=chunk).collect()
            assert {r.file_name: r.file_hash for r in rows} == {
                n: hashlib.sha256(b).hexdigest() for n, b in bodies.items() if n != "n.txt"}
            assert {r.file_name: r.file_size_bytes for r in rows}["a b%20c.pdf"] == 100_000
    reader = files.StagedReader({"path": folder, "partitionbytes": str(5 << 20)})
    assert sorted(len(p.files) for p in reader.partitions()) == [1, 1, 1, 1]
    assert list(files.StagedReader({"path": folder}).read(reader.partitions()[0]))[0][4] is None
    os.mkdir(os.path.join(folder, "sub"))
    assert files.scan_staging(spark, os.path.join(folder, "sub")).count() == 0


def test_snapshot_versions(spark, folder):
    table = snapshots.SnapshotTable(spark, f"{folder}/core", schemas.CORE_DOCUMENTS)
    assert table.read().count() == 0 and table.current() is None
    table.write(core(spark, [{"subject": "a"}]), "run-1")
    old = table.read()
    table.write(core(spark, [{"subject": "b"}, {"subject": "c"}]), "run-2", ["fy_year"])
    table.write(core(spark, []), "run-2")  # complete already: not redone
    assert table.current() == "run-2" and table.read().count() == 2
    assert old.count() == 1


def test_run_log(spark, folder):
    path = f"{folder}/log"
    first = runlog.start_run(spark, path, "extract")
    runlog.end_run(spark, path, first, "extract", "FAILED", error="boom")
    second = runlog.start_run(spark, path, "extract")
    log = spark.read.schema(schemas.RUN_LOG).parquet(path)
    newest = runlog.latest_run(log, "extract").first()
    assert (newest.batch_id, newest.status, newest.duration_secs) == (second, "STARTED", None)
    assert values(runlog.runs(log), "status", "error_msg") == [("FAILED", "boom"), ("STARTED", None)]


def test_provider_layouts_follow_the_seeds(spark):
    assert [x.provider for x in statements.seeded_layouts()] == [
        r.provider_nme for r in seeds.statement_providers(spark).orderBy("provider_id").collect()
    ]


@pytest.mark.parametrize("block", ["128m", "40"])
def test_inch_signs_and_quotes_that_are_never_closed(spark, folder, block):
    bodies = {
        "bendigo-inch.csv": [
            '24/03/2026,10.00,,TV 42" WALL MOUNT,5.00',
            '25/03/2026,,7.00,"two, ""of""',
            'them",12.00',
            "26/03/2026,1.00,,plain,11.00",
            '27/03/2026,1.00,,a 7" and 8" cut,10.00',
            "28/03/2026,1.00,,last,9.00",
        ],
        "bendigo-open.csv": [
            "24/03/2026,10.00,,first,5.00",
            '25/03/2026,1.00,,"never closed,4.00',
            "26/03/2026,1.00,,behind it,3.00",
            "",
            '27/03/2026,1.00,,the end,2.00',
        ],
    }
    for name, lines in bodies.items():
        with open(os.path.join(folder, name), "w") as handle:
            handle.write("\n".join(["Date,Debit,Credit,Description,Balance", *lines]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = statements.read_statement(spark, folder, F.lit(1)).orderBy("row_num").collect()
        rejects = transactions.rejected_rows(
            transactions.normalise_transactions(
                statements.read_statement(spark, folder, F.lit(1)), seeds.statement_providers(spark)
            )
        ).orderBy("row_num").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    inch = [r for r in rows if r.source_file.endswith("inch.csv")]
    assert [(r.row_num, r.description_raw) for r in inch] == [
        (1, 'TV 42" WALL MOUNT'),
        (2, 'two, "of"\nthem'),
        (4, "plain"),
        (5, 'a 7" and 8" cut'),
        (6, "last"),
    ]
    assert [r.balance_raw for r in inch] == ["5.00", "12.00", "11.00", "10.00", "9.00"]
    other = [r for r in rows if r.source_file.endswith("open.csv")]
    assert [(r.row_num, r.description_raw) for r in other] == [
        (1, "first"), (2, None), (3, None), (5, None)
    ]
    lines = bodies["bendigo-open.csv"]
    assert [r.row_num for r in rejects] == [2, 3, 5]
    kept = [json.loads(r.raw_json)["column_6"] for r in other[1:]]
    assert kept == [lines[1], lines[2], lines[4]]


def test_a_run_takes_all_from_its_newest_closing_row(spark):
    import datetime

    def row(status, second, **more):
        return {"batch_id": "b", "workflow_nme": "w", "status": status,
                "logged_at": datetime.datetime(2025, 1, 1, 0, 0, second), **more}

    from tests.rows import frame

    log = frame(spark, schemas.RUN_LOG, [
        row("STARTED", 1, rows_extracted=0), row("FAILED", 2, rows_extracted=9, error_msg="old"),
        row("SUCCESS", 3, rows_extracted=4, rows_loaded=4)])
    assert values(runlog.runs(log), "status", "rows_extracted", "error_msg") == [("SUCCESS", 4, None)]
    started = runlog.runs(log.filter("status = 'STARTED'"))
    assert values(started, "status", "rows_extracted", "completed_at") == [("STARTED", 0, None)]


def test_every_dropped_part_is_written_by_a_task_of_its_own(spark, folder):
    import glob
    import os

    from ledgermill.plans import queries_flow

    sf = f"{folder}/sf"
    rows = [(i, f"text {i}") for i in range(200)] + [(None, "none"), (-3, "below")]
    spark.createDataFrame(rows, "doc_id LONG, text STRING").write.parquet(f"{sf}/documents.parquet")
    queries_flow._drop_documents(spark, sf, f"{folder}/drop", "pdf")
    tasks = {}
    for path in glob.glob(f"{folder}/drop/p=*/part-*.pdf"):
        part = os.path.basename(os.path.dirname(path))
        tasks.setdefault(part, []).append(os.path.basename(path).split("-")[1])
    assert all(len(found) == 1 for found in tasks.values())
    assert len({tasks[f"p={i}"][0] for i in range(16)}) == 16
    with open(glob.glob(f"{folder}/drop/p=3/part-*.pdf")[0]) as handle:
        lines = handle.read().splitlines()
    assert lines == ["x" + f"text {i}".encode().hex().upper() for i in range(3, 200, 16)]


def test_lines_are_not_shuffled_to_be_numbered(spark, folder):
    with open(f"{folder}/a.csv", "w") as handle:
        handle.write("Date,Amount\n" + "".join(f"1 Jan 24,{i}\n" for i in range(50)))
    lines = statements._numbered_lines(spark, folder)
    assert "hashpartitioning" not in lines._jdf.queryExecution().executedPlan().toString()
    found = sorted((r["line_no"], r["record_no"]) for r in lines.collect())
    assert found == [(i, i) for i in range(1, 52)]


def test_first_lines_and_paths_are_not_shuffled(spark, folder, monkeypatch):
    """A file is described from its first lines, and joined lines go by its number."""
    for name, day in (("nab-a.csv", 1), ("nab-b.csv", 2)):
        with open(os.path.join(folder, name), "w") as handle:
            handle.write("Date,Amount,Transaction Details,Balance\n" + "".join(
                f'{day} Mar 26,-{i}.00,"row\n{i}",0\n' for i in range(1, 40)))
    lines = statements._numbered_lines(spark, folder)
    numbers = lines.groupBy("file").agg(F.countDistinct("file_no").alias("n"), F.min("file_no").alias("no")).collect()
    assert [r.n for r in numbers] == [1, 1] and len({r.no for r in numbers}) == 2
    joined, join = [], statements._joined_records
    monkeypatch.setattr(statements, "_joined_records", lambda rows: joined.append(rows.count()) or join(rows))
    found = statements.read_statement(spark, folder, F.lit(1))
    assert joined[0] < 20 and joined[1] == lines.count() == 158
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "hashpartitioning" in x]
    assert exchanges and all("file_no#" in x and "file#" not in x for x in exchanges)
    assert sorted((r.txn_date_raw, r.amount_raw, r.description_raw) for r in found.collect()) == sorted(
        (f"{day} Mar 26", f"-{i}.00", f"row\n{i}") for day in (1, 2) for i in range(1, 40))


def test_staging_writes_the_documents_once_and_leaves_no_shuffled_texts(spark, folder, monkeypatch):
    import hashlib
    import os
    import time

    from ledgermill.plans import queries_flow

    sf = f"{folder}/sf"
    rows = [(i % 40, f"text {i}") for i in range(0, 80, 2)] + [(None, "none"), (3, None)]
    spark.createDataFrame(rows, "doc_id LONG, text STRING").write.parquet(f"{sf}/documents.parquet")
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return {
            name
            for top in dirs.localDirs()
            for _, _, names in os.walk(top.toString())
            for name in names
            if name.startswith("shuffle_") and name.endswith(".data")
        }

    before, written, scratch = shuffled(), [], f"{folder}/staging"
    drop = queries_flow._drop_documents
    monkeypatch.setattr(queries_flow, "scratch_dir", lambda *_: scratch)
    monkeypatch.setattr(
        queries_flow, "_drop_documents", lambda *given: written.append(given[3]) or drop(*given)
    )
    found = queries_flow.staging_scan(spark, sf)
    assert written == ["pdf"]
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before

    held = {}
    for top, _, names in os.walk(scratch):
        for name in names:
            if not name.startswith((".", "_")):
                with open(f"{top}/{name}", "rb") as handle:
                    body = handle.read()
                held.setdefault(name.rpartition(".")[2], []).append((os.path.basename(top), body))
    once = sorted(held["csv"])
    assert len(once) == 10 and sorted(held["pdf"]) == sorted(2 * once)
    digests = sorted({hashlib.sha256(body).hexdigest() for _, body in once})
    assert [tuple(r) for r in found.orderBy("file_ext").collect()] == [
        ("csv", 10, None, None, None),
        (
            "pdf", 20, len(digests), 2 * sum(len(body) for _, body in once),
            hashlib.md5(",".join(digests).encode()).hexdigest(),
        ),
    ]


def test_a_copied_file_is_whole_and_keeps_its_place(spark, folder):
    import os

    for path, body in (("a.pdf", b"x" * 10_000), ("sub/a.csv", b""), ("sub/a b%20.txt", b"1")):
        os.makedirs(os.path.dirname(f"{folder}/{path}"), exist_ok=True)
        with open(f"{folder}/{path}", "wb") as handle:
            handle.write(body)
    files.copy_staging(spark, folder, ("pdf", "csv"))
    found = {
        os.path.relpath(f"{top}/{name}", folder): os.path.getsize(f"{top}/{name}")
        for top, _, names in os.walk(folder)
        for name in names
    }
    assert found == {
        "a.pdf": 10_000, "copy-0-a.pdf.pdf": 10_000, "copy-1-a.pdf.csv": 10_000,
        "sub/a.csv": 0, "sub/copy-0-a.csv.pdf": 0, "sub/copy-1-a.csv.csv": 0,
        "sub/a b%20.txt": 1, "sub/copy-0-a b%20.txt.pdf": 1, "sub/copy-1-a b%20.txt.csv": 1,
    }
    files.copy_beside(f"{folder}/a.pdf", ["b.pdf"], chunk_bytes=7)
    with open(f"{folder}/b.pdf", "rb") as handle:
        assert handle.read() == b"x" * 10_000
