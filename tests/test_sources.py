import json
import re

import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from siltgate.operators import responses as r
from siltgate.operators.responses import Paging
from siltgate.sources import csv_files
from siltgate.sources.csv_files import CsvOptions, envelope, read_csv
from siltgate.sources.documents import documents_from, find_filter, key_text, limited, read_documents
from workloads import files, inputs

# --- CSV folders ------------------------------------------------------------------


def write(folder, **files):
    for name, content in files.items():
        path = folder / name.replace("__", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder)


def normalized(scan):
    rows = scan.records.orderBy("source_file", "row_number").collect()
    return [(x["source_file"], x["row_number"], x["normalized_record"].asDict()) for x in rows]


def test_two_files_in_nested_folders(spark, tmp_path):
    write(tmp_path / "sub", b__csv="id,value\n2,B\n")
    folder = write(tmp_path, a__csv="id,value\n1,A\n", note__txt="x", **{"__hidden__csv": "id,value\n9,Z\n"})
    scan = read_csv(spark, folder, RUN_TS)
    assert normalized(scan) == [("a.csv", 1, {"id": "1", "value": "A"}), ("b.csv", 1, {"id": "2", "value": "B"})]
    summary = scan.summary().first()
    assert (summary["file_count"], summary["record_count"], summary["error_count"]) == (2, 2, 0)
    assert scan.records.first()["ingestion_timestamp"] == RUN_TS.isoformat()


def test_missing_folder_and_plain_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none"), RUN_TS)
    write(tmp_path, a__csv="id\n1\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "a.csv"), RUN_TS)


def test_empty_folder(spark, tmp_path):
    scan = read_csv(spark, str(tmp_path), RUN_TS)
    assert scan.records.count() == 0 and scan.errors.count() == 0 and scan.file_count == 0


MESSY = (
    "id, name ,note\n"
    "1, Ann\t,x\n"
    "\n"
    ",  ,\n"
    "2\n"
    '3,"Bo ""B""\nsecond",y\n'
    "4,Cy,\n"
    "5,a,b,c\n"
    "6,Di,z\n"
)


def test_messy_file(spark, tmp_path):
    folder = write(tmp_path, m__csv=MESSY, n__csv="id, name ,note\n7,E,f\n")
    scan = read_csv(spark, folder, RUN_TS)
    assert normalized(scan) == [
        ("m.csv", 1, {"id": "1", "name": "Ann", "note": "x"}),
        ("m.csv", 4, {"id": "3", "name": 'Bo "B"\nsecond', "note": "y"}),
        ("m.csv", 5, {"id": "4", "name": "Cy", "note": ""}),
        ("n.csv", 1, {"id": "7", "name": "E", "note": "f"}),
    ]
    errors = scan.errors.orderBy(F.col("row_number").asc_nulls_last()).collect()
    assert [(e["row_number"], e["error"]) for e in errors] == [
        (3, "Row has missing column value(s)."),
        (None, "Failed to process file: row 6 has more values than the header"),
    ]
    assert errors[0]["row"] == "2"
    assert scan.skipped.first()["skipped"] == 1


def test_files_with_different_headers(spark, tmp_path):
    folder = write(tmp_path, a__csv="id,x\n1,a\n", b__csv="y,id\nb,2\n")
    maps = {e["source_file"]: e["normalized_record"] for e in envelope(read_csv(spark, folder, RUN_TS).records).collect()}
    assert maps == {"a.csv": {"id": "1", "x": "a"}, "b.csv": {"id": "2", "y": "b"}}


def test_delimiter_encoding_and_no_header(spark, tmp_path):
    folder = write(tmp_path, a__csv="1;é\n2;b\n".encode("latin-1"))
    options = CsvOptions(delimiter=";", encoding="ISO-8859-1", has_header=False)
    assert [x[2] for x in normalized(read_csv(spark, folder, RUN_TS, options))] == [
        {"_c0": "1", "_c1": "é"}, {"_c0": "2", "_c1": "b"},
    ]


def test_undecodable_file_fails_alone(spark, tmp_path):
    folder = write(tmp_path / "odd %20 name+", a__csv=b"id,v\n1,\xff\n", b__csv="id,v\n2,�\n")
    scan = read_csv(spark, folder, RUN_TS)
    assert [x[0] for x in normalized(scan)] == ["b.csv"]
    error = scan.errors.first()
    assert (error["source_file"], error["row_number"], error["error"]) == (
        "a.csv", None, "Failed to process file: not valid utf-8",
    )


@pytest.mark.parametrize("multi_line", [True, False])
def test_row_numbers_across_splits(spark, tmp_path, multi_line):
    lines = "".join(f"{i},{'x' * (i % 40)}\n" for i in range(1, 4001))
    spoiled = lines.replace("3000," + "x" * (3000 % 40), "3000,a,b,c")
    folder = write(tmp_path, a__csv="id,v\n" + lines, b__csv="id,v\n" + spoiled)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        scan = read_csv(spark, folder, RUN_TS, CsvOptions(multi_line=multi_line))
        rows = scan.rows.select("source_file", "row_number", "id").collect()
        errors = scan.errors.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert all(x["row_number"] == int(x["id"]) for x in rows)
    assert sum(x["source_file"] == "a.csv" for x in rows) == 4000
    assert sum(x["source_file"] == "b.csv" for x in rows) == 2999
    assert [e["error"] for e in errors] == ["Failed to process file: row 3000 has more values than the header"]


ENCODINGS = ["utf-8", "utf-16", "utf-16-le", "utf-16-be", "latin-1", "cp1252", "shift_jis"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("encoding", ENCODINGS)
@pytest.mark.parametrize("split", ["2k", "128m"])
def test_encodings_above_one_split(spark, tmp_path, encoding, split, end):
    letter = "ア" if encoding == "shift_jis" else "é"
    text = f"id,v{end}" + "".join(f'{i},"{letter}{i % 7},\n"{end}' for i in range(1, 1001))
    folder = write(tmp_path, a__csv=text.encode(encoding))
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        scan = read_csv(spark, folder, RUN_TS, CsvOptions(encoding=encoding))
        rows = scan.rows.select("row_number", "id", "v").collect()
        assert scan.errors.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert sorted(tuple(x) for x in rows) == [(i, str(i), f"{letter}{i % 7},") for i in range(1, 1001)]


BROKEN = {
    "utf-8": b"\xff", "utf-16": b"\x00\xd8", "utf-16-le": b"\x00\xd8", "utf-16-be": b"\xd8\x00", "cp1252": b"\x81", "shift_jis": b"\x81\xff",
}


@pytest.mark.parametrize("encoding", ENCODINGS)
@pytest.mark.parametrize("split", ["2k", "128m"])
def test_undecodable_bytes_in_any_encoding(spark, tmp_path, encoding, split):
    """A broken file gives one error; a file that holds the replacement character itself none."""
    good = "id,v\n" + "".join(f"{i},abc\n" for i in range(1, 400))
    files = {"good__csv": good.encode(encoding)}
    if encoding in BROKEN:
        # After the last whole line, as two bytes a character would shift what follows.
        tail = "400,x".encode(encoding)[2 if encoding == "utf-16" else 0 :]
        files["bad__csv"] = files["good__csv"] + tail + BROKEN[encoding] + ("\n".encode(encoding)[-2:] if "16" in encoding else b"\n")
    if encoding.startswith("utf"):
        files["shown__csv"] = (good + "400,\ufffd\n").encode(encoding)
    folder = write(tmp_path, **files)
    rows, errors = scan_in_splits(spark, folder, split, encoding=encoding)
    assert {r["source_file"] for r in rows} == {n.replace("__", ".") for n in files} - {"bad.csv"}
    expected = [("bad.csv", None, f"Failed to process file: not valid {encoding}")] if encoding in BROKEN else []
    assert [(e["source_file"], e["row_number"], e["error"]) for e in errors] == expected


def test_utf_16_without_a_mark_and_a_broken_header(spark, tmp_path):
    folder = write(
        tmp_path, marked__csv="id,v\n1,é\n".encode("utf-16"), plain__csv="id,v\n2,ü\n".encode("utf-16-le")
    )
    scan = read_csv(spark, folder, RUN_TS, CsvOptions(encoding="utf-16"))
    assert [x[2] for x in normalized(scan)] == [{"id": "1", "v": "é"}, {"id": "2", "v": "ü"}]
    folder = write(tmp_path / "odd", a__csv=b"id,v\xff\n1,x\n", b__csv="id,v\n2,y\n")
    scan = read_csv(spark, folder, RUN_TS)
    assert [x[0] for x in normalized(scan)] == ["b.csv"] and scan.errors.first()["source_file"] == "a.csv"


def test_names_and_folders_that_spark_hides(spark, tmp_path):
    for place in ("", "sub", ".dot", "_under", "sub/.deep [x]/_in", "a=b"):
        write(tmp_path / place, plain__csv="id,v\n1,a\n", **{"_x__csv": "id,v\n2,b\n3,�\n", "__y__csv": "id,v\n4,c\n"})
    write(tmp_path, **{"_x__txt": "id,v\n9,z\n"})
    scan = read_csv(spark, str(tmp_path), RUN_TS)
    assert scan.file_count == 12 and scan.errors.count() == 0
    rows = scan.rows.select("source_path", "source_file", "row_number", "id").collect()
    assert len(rows) == 6 * 3 and {r["source_file"] for r in rows} == {"plain.csv", "_x.csv"}
    hidden = sorted(r["source_path"].split(tmp_path.name, 1)[1] for r in rows if r["id"] == "2")
    assert hidden == sorted(f"{p}/_x.csv" for p in ("", "/sub", "/.dot", "/_under", "/sub/.deep [x]/_in", "/a=b"))
    assert {(r["id"], r["row_number"]) for r in rows} == {("1", 1), ("2", 1), ("3", 2)}
    bad = write(tmp_path / "bad", **{"_z__csv": b"id,v\n1,\xff\n"})
    assert read_csv(spark, bad, RUN_TS).errors.first()["source_file"] == "_z.csv"


def test_row_numbers_of_many_splits_shuffle_no_row(spark, tmp_path):
    folder = write(tmp_path, **{f"f{i}__csv": "id,v\n" + "1,x\n" * 5 for i in range(40)})
    rows = read_csv(spark, folder, RUN_TS).rows
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and rows.count() == 200


def test_more_than_a_thousand_files(spark, tmp_path):
    folder = write(tmp_path, **{f"f{i}__csv": f"id,v\n{i},x\n" for i in range(1100)})
    scan = read_csv(spark, folder, RUN_TS)
    assert (scan.file_count, scan.records.count(), scan.errors.count()) == (1100, 1100, 0)


# --- documents ---------------------------------------------------------------------


def test_documents_and_bad_lines(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"_id": {"$oid": "a1"}, "x": 1}\nnot json\n[1]\n{"_id": 5}\n')
    scan = read_documents(spark, str(tmp_path / "d.json"), "users", RUN_TS)
    keys = scan.documents.selectExpr(f"{key_text('document')} as k")
    assert sorted(x["k"] for x in keys.collect()) == ["5", "a1"]
    assert sorted((e["error"], e["row"]) for e in scan.errors.collect()) == [
        ("not a document", "[1]"), ("not valid JSON", "not json"),
    ]
    assert limited(scan.documents, 1).count() == 1 and limited(scan.documents, 0).count() == 2


def test_find_filter(documents):
    frame = documents(
        {"n": 5, "s": "a"}, {"n": 7.5, "s": "b"}, {"n": "5"}, {"n": None}, {}, {"n": [1, 5]}, {"a": {"b": True}}, {"n": True}
    )

    def found(query):
        return sorted(x["pos"] for x in frame.filter(find_filter(query, "document")).collect())

    assert found({}) == list(range(8))
    assert found({"n": 5}) == [0, 5]
    assert found({"n": {"$gt": 4, "$lte": 7.5}}) == [0, 1, 5]
    assert found({"n": "5"}) == [2]
    assert found({"n": None}) == [3, 4, 6]
    assert found({"n": {"$ne": 5}}) == [1, 2, 3, 4, 6, 7]
    assert found({"n": {"$in": [7.5, "5"]}}) == [1, 2]
    assert found({"n": {"$nin": [5, 7.5, None]}}) == [2, 7]
    assert found({"n": {"$exists": False}}) == [4, 6]
    assert found({"a.b": True}) == [6]
    assert found({"$or": [{"s": "a"}, {"n": {"$exists": False}}], "n": 5}) == [0]
    assert found({"$nor": [{"n": {"$exists": True}}]}) == [4, 6]
    assert found({"n": {"$not": {"$gt": 4}}}) == [2, 3, 4, 6, 7]
    with pytest.raises(ValueError):
        find_filter({"n": {"$near": 1}}, "document")


# --- landed pages ------------------------------------------------------------------


def pages(spark, *bodies, source="s"):
    rows = [(source, i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    frame = spark.createDataFrame(rows, "source string, page_index long, body string")
    return frame.selectExpr("*", "200 as status", "concat('u', page_index) as url")


def walk(spark, paging, *bodies):
    assembled = r.assemble(r.parse(pages(spark, *bodies), paging), paging)
    found = r.records(assembled).selectExpr("page_index", "position", "to_json(record) as j")
    got = [json.loads(x["j"]) for x in found.orderBy("page_index", "position").collect()]
    errors = [(e["page"], e["error"]) for e in r.page_errors(assembled).collect()]
    return got, errors, r.page_summary(assembled).first()["pages_fetched"]


def items(*numbers):
    return [{"id": n} for n in numbers]


def test_bodies(spark):
    assert walk(spark, Paging(), items(1, 2)) == (items(1, 2), [], 1)
    assert walk(spark, Paging(records_path="data.items"), {"data": {"items": items(1)}}) == (items(1), [], 1)
    assert walk(spark, Paging(), {"id": 1, "name": "solo"}) == ([{"id": 1, "name": "solo"}], [], 1)
    assert walk(spark, Paging(), "<html>") == ([], [(0, r.NOT_JSON)], 0)
    assert walk(spark, Paging(), 5) == ([], [(0, r.NEITHER)], 0)
    assert walk(spark, Paging(records_path="a"), {"b": 1}) == (
        [], [(0, "path 'a' not found in response payload.")], 0,
    )


def test_stop_rules(spark):
    size2 = Paging(page_size=2)
    assert walk(spark, size2, items(1, 2), items(3, 4), items(5), items(6, 7)) == (items(1, 2, 3, 4, 5), [], 3)
    assert walk(spark, size2, [], items(1, 2)) == ([], [], 1)
    assert walk(spark, Paging(page_size=2, max_pages=2), *[items(1, 2)] * 4)[2] == 2
    assert walk(spark, Paging(), items(1), items(2)) == (items(1), [], 1)
    total = Paging("offset", 0, 2, records_path="r", total_path="t")
    full = [{"r": items(i, i + 1), "t": 4} for i in (1, 3, 5)]
    assert walk(spark, total, *full) == (items(1, 2, 3, 4), [], 2)
    words = [{"r": items(1, 2), "t": "4"}, {"r": items(3), "t": 4.0}]
    assert walk(spark, total, *words) == (items(1, 2, 3), [], 2)


def test_an_error_page_ends_the_walk(spark):
    got, errors, fetched = walk(spark, Paging("offset", 10, 2), items(1, 2), "oops", items(3, 4))
    assert (got, fetched) == (items(1, 2), 1)
    assert errors == [(12, r.NOT_JSON)]


def test_requests_of_landed_pages(spark):
    pages = spark.createDataFrame([("a", 0), ("a", 2), ("b", 0)], "source string, page_index long")
    found = r.landed_requests(pages, Paging("offset", start_page=0, page_size=5)).orderBy("source", "page_index")
    assert [tuple(x) for x in found.collect()] == [("a", 0, 0, 5), ("a", 1, 5, 5), ("a", 2, 10, 5), ("b", 0, 0, 5)]


def test_page_plan(spark):
    def values(paging, n=3):
        return [x["page_value"] for x in r.page_plan(spark, paging, n).orderBy("page_index").collect()]

    assert values(Paging("offset", 0, 10)) == [0, 10, 20]
    assert values(Paging("page", 1, 10)) == [1, 2, 3]
    assert values(Paging()) == [None]
    with pytest.raises(ValueError):
        Paging("cursor")


def log(spark, *rows):
    return spark.createDataFrame(list(rows), "page_index long, attempt int, status int, body string").selectExpr(
        "'s' as source", "*"
    )


def test_final_attempts(spark):
    frame = log(
        spark,
        (0, 1, 503, ""), (0, 2, 200, "[]"), (0, 3, 200, "late"),
        (1, 1, None, None), (1, 2, None, None), (1, 3, None, None), (1, 4, None, None), (1, 5, 200, "past"),
        (2, 1, 404, "x" * 400),
        (3, 1, 401, ""),
        (4, 1, 429, ""), (4, 2, 500, ""),
        (5, 1, 503, ""), (5, 2, 503, ""), (5, 3, 503, ""), (5, 4, 503, "busy"),
    )
    rows = {x["page_index"]: x for x in r.final_attempts(frame).collect()}
    assert [(rows[i]["attempt"], rows[i]["outcome"]) for i in range(6)] == [
        (2, "success"), (4, "error"), (1, "error"), (1, "auth_error"), (2, "retry"), (4, "error"),
    ]
    assert rows[0]["waited_seconds"] == 1.0 and rows[1]["waited_seconds"] == 7.0
    assert rows[1]["error"] == "Request failed after 4 attempt(s)"
    assert rows[2]["error"] == "Non-success response status 404: " + "x" * 300
    assert rows[5]["error"] == "Non-success response status 503: busy"
    delays = r.retry_delays(r.classify(frame)).filter("page_index = 5").orderBy("attempt").collect()
    assert [d["delay_seconds"] for d in delays] == [1.0, 2.0, 4.0, None]
    with pytest.raises(Exception, match="authentication failed"):
        r.require_authorized(r.final_attempts(frame)).collect()


def test_documents_from_other_columns(spark):
    frame = spark.sql("select 7 as k, '{\"a\": 1}' as line")
    row = documents_from(frame, "line", "c", RUN_TS).documents.first()
    assert row["k"] == 7 and row["source_collection"] == "c"


def scan_in_splits(spark, folder, size, **options):
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        scan = read_csv(spark, folder, RUN_TS, CsvOptions(**options))
        rows = scan.records.orderBy("source_file", "row_number").collect()
        errors = scan.errors.orderBy("source_file", F.col("row_number").asc_nulls_last()).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    return [r.asDict(recursive=True) for r in rows], [e.asDict() for e in errors]


def quoted_lines(n, spoil=None):
    """Rows whose notes span up to four lines, some with blank and empty lines between."""
    out = ["id,note,tag"]
    for i in range(1, n + 1):
        note = "\n".join(f'line {j} of ""{i}"", more' for j in range(i % 5)) or "plain"
        out.append(spoil.get(i) if spoil and i in spoil else f'{i},"{note}",t{i % 3}')
        if i % 50 == 0:
            out += ["", "   "]
    return "\n".join(out) + "\n"


def test_quoted_lines_in_splits_match_the_whole_read(spark, tmp_path):
    folder = write(tmp_path, a__csv=quoted_lines(600), b__csv=quoted_lines(500, {400: "400,x,y,z", 77: "77"}).replace("\n", "\r\n"))
    assert scan_in_splits(spark, folder, 4096) == scan_in_splits(spark, folder, 1 << 27, multi_line=True)


def test_stray_quotes_fall_back_to_the_whole_read(spark, tmp_path):
    folder = write(tmp_path / "x y", b__csv=quoted_lines(200), a__csv=quoted_lines(300, {150: '150,5" pipe,t'}))
    rows, errors = scan_in_splits(spark, folder, 4096)
    assert (rows, errors) == scan_in_splits(spark, folder, 1 << 27, multi_line=True)
    assert rows[149]["normalized_record"]["note"] == '5" pipe'


def test_first_lines_of_many_files_are_read_by_tasks(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    bodies = {"a/1.csv": "id,n\n1,x\n", "a/2 %41.csv": "id,n\r\n2,y\r\n", "b/3.csv": "n,k\rz,3\r", "b/4.csv": "", "c/_6.csv": "id,n\n6,q\n", "_d/7.csv": "\ufeffid,n\n7,u\n"}
    for name, body in bodies.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(body.encode())
    (folder / "a/8.csv").write_bytes(b"i\xffd,n\n8,v\n")

    def read():
        scan = read_csv(spark, str(folder), RUN_TS)
        errors = [(e["source_file"], e["error"]) for e in scan.errors.collect()]
        return scan.rows.columns, sorted(map(tuple, scan.rows.collect()), key=str), errors, scan.file_count

    one_by_one = read()
    opened = []
    here = csv_files.first_line
    monkeypatch.setattr(csv_files, "MANY_FILES", 2)
    monkeypatch.setattr(csv_files, "first_line", lambda spark, path, charset: opened.append(path) or here(spark, path, charset))
    assert read() == one_by_one
    assert sorted(p.rsplit("/", 1)[1] for p in opened) == ["4.csv", "silt=_6.csv"]  # an empty and a copied one


def test_many_files_of_one_header_are_read_by_folder(spark, tmp_path, monkeypatch):
    for i in range(6):
        (tmp_path / f"p={i}").mkdir()
        (tmp_path / f"p={i}" / f"{i}.csv").write_text(f"id,n\n{i},x\n")
    (tmp_path / "p=0" / "other.txt").write_text("no,csv,at all")
    monkeypatch.setattr(csv_files, "MANY_FILES", 2)
    asked = []
    here = csv_files._read
    monkeypatch.setattr(csv_files, "_read", lambda s, paths, *rest: asked.append(len(paths)) or here(s, paths, *rest))
    rows = read_csv(spark, str(tmp_path), RUN_TS).rows
    assert rows.columns == ["source_file", "source_path", "row_number", "id", "n"]
    assert sorted(r["id"] for r in rows.collect()) == list("012345") and asked == [1]


def test_small_files_are_written_by_several_tasks(spark):
    lines = spark.range(64).selectExpr("id div 4 as file_no", "id as pos", "cast(id as string) as line")
    folder = files.write_lines(lines, "written")
    written = spark.read.text(folder)
    assert written.count() == 64 and len(written.inputFiles()) == 16
    assert len({re.search(r"part-(\d+)", f)[1] for f in written.inputFiles()}) > 1


def test_landed_files_are_written_by_all_cores(spark, tmp_path):
    spark.range(1_000).selectExpr("id as c_custkey").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    text = "select cast(c_custkey as string) as line from customer"
    folder = inputs.land_files(spark, str(tmp_path), "spread", lambda rows, path: rows.write.text(path), text, "customer")
    rows = spark.read.text(folder).select("value", "_metadata.file_path").collect()
    assert sorted(int(r["value"]) for r in rows) == list(range(1_000))
    assert len({r["file_path"] for r in rows}) == spark.sparkContext.defaultParallelism
