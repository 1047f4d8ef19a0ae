"""Files that are cut into many blocks, against the same files read at once."""

import csv
import json
import random

import pytest
from pyspark.sql import types as T

from weirgate.operators.records import split
from weirgate.sources import delimited, files


@pytest.fixture
def small_blocks(spark):
    """A session whose splits are so small that records, strings and leading lines cross them."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and session.conf.get(key, None) != value:
            session.conf.set(key, value)

    def of(size):
        session.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        session.conf.set("spark.sql.files.openCostInBytes", "1")
        return session

    return of


def odd_field(rng):
    parts = ["a", "bc", " ", "\n", "\r\n", "\n\n", '"', '""', ",", "x\ny", "é", "long " * 9]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))


def write_csv(path, rows, rng):
    """Rows with all odd fields quoted, some plain ones with quotes inside, and either kind of line end."""
    with open(path, "w", encoding="utf-8", newline="") as f:
        for row in rows:
            plain = [v for v in row]
            cells = [v if rng.random() < 0.3 and not set(v) & set('\n\r,') and not v.startswith('"') else '"' + v.replace('"', '""') + '"' for v in plain]
            f.write(",".join(cells) + rng.choice(["\n", "\r\n"]))


@pytest.mark.parametrize("size, seed", [(1000, 2), (4000, 4), (1 << 20, 5)])
def test_quoted_line_breaks_over_blocks(small_blocks, tmp_path, size, seed):
    rng = random.Random(seed)
    want = []
    for name in "abc":
        rows = [[f"{name}{i}", odd_field(rng), odd_field(rng)] for i in range(300)]
        write_csv(tmp_path / f"{name}.csv", [["id", "x", "y"], *rows], rng)
        want += [tuple(r) for r in rows]
    spark = small_blocks(size)
    rows = split(delimited.delimited_scan(spark, str(tmp_path), multi_line=True, markers=()))
    assert rows.invalid.count() == 0
    assert sorted(tuple(r) for r in rows.valid.select("id", "x", "y").collect()) == sorted(want)
    files = rows.valid.select("source_name", "id").collect()
    assert all(r.source_name.endswith(f"/{r.id[0]}.csv") for r in files)
    if size < 1 << 20:
        assert rows.valid.rdd.getNumPartitions() > 8


def test_records_that_fill_many_blocks(small_blocks, tmp_path):
    long = "\n".join(f"line {i}" for i in range(900))
    with open(tmp_path / "a.csv", "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([["id", "x"], ["1", long], ["2", ""], ["3", long + '"' + long], ["4", "end"]])
    rows = split(delimited.delimited_scan(small_blocks(1500), str(tmp_path), multi_line=True))
    assert {(r.id, r.x) for r in rows.valid.collect()} == {("1", long), ("2", ""), ("3", long + '"' + long), ("4", "end")}


@pytest.mark.parametrize("size", [1000, 1 << 20])
def test_a_quote_that_never_closes(small_blocks, tmp_path, size):
    rest = '2,"open\n3,c\n\n4,d' + "\n5,e" * 900
    (tmp_path / "a.csv").write_text("id,x\n1,a\n" + rest + "\n")
    parts = split(delimited.delimited_scan(small_blocks(size), str(tmp_path), multi_line=True))
    assert [(r.id, r.x) for r in parts.valid.collect()] == [("1", "a")]
    assert [r.error_record for r in parts.invalid.collect()] == [rest]


def test_different_headers_and_skipped_rows(small_blocks, tmp_path):
    (tmp_path / "a.csv").write_text('about "this\n\nid,x\n' + '1,"p\nq"\n' * 200)
    (tmp_path / "b.csv").write_text('more\nx,id\n' + '"r\n\ns",2\n' * 200)
    for size in (700, 1 << 20):
        rows = split(delimited.delimited_scan(small_blocks(size), str(tmp_path), multi_line=True, skip_rows=1)).valid
        assert sorted((r.id, r.x) for r in rows.collect()) == [("1", "p\nq")] * 200 + [("2", "r\n\ns")] * 200


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize("header", [True, False])
def test_leading_lines_longer_than_a_split(small_blocks, tmp_path, multi_line, header):
    names = T._parse_datatype_string("id string, x string")
    lead = "".join(f"comment {i} {'z' * i}\n" for i in range(30))
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(lead + ("\n \nid,x\n" if header else "") + "".join(f"{name}{i},{i}\n" for i in range(50)))
    (tmp_path / "c.csv").write_text("short\n" * 30 + ("id,x\n" if header else "") + "c0,0\n")
    spark = small_blocks(500)
    scan = delimited.delimited_scan(spark, str(tmp_path), skip_rows=30, header=header, schema=None if header else names, multi_line=multi_line, extra_columns=0)
    rows = split(scan).valid
    assert sorted(r.id for r in rows.collect()) == sorted([f"{n}{i}" for n in "ab" for i in range(50)] + ["c0"])


def test_lexer_against_the_csv_module():
    """Where lines end inside quotes, for random lines from either state."""
    rng = random.Random(9)
    quotes = delimited.Quotes(",")
    for _ in range(3000):
        line = "".join(rng.choice('ab,""') for _ in range(rng.randint(0, 12)))
        for inside in (False, True):
            text = ('"x' if inside else "") + ("\n" if inside else "") + line + "\nEND"
            rows = list(csv.reader(text.splitlines(keepends=True)))
            assert quotes.after(inside, line) == (rows[-1] != ["END"]), (inside, line)


def odd_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind == 0:
        return rng.randint(-9, 9)
    if kind == 1:
        return rng.choice([None, True, 1.5])
    if kind < 5:
        return "".join(rng.choice(['"', "\\", ",", "[", "]", "{", "}", "é", "\n", " ", "abc", '\\"', "\\\\"]) for _ in range(rng.randint(0, 9)))
    if kind == 5:
        return [odd_value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(["k", "a,b", 'q"', "r", "\\"]): odd_value(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def documents_of(rng, root):
    """Texts of documents with their lists, or without, whole and broken."""
    for n in (0, 1, 2, 30, 80):
        items = [{"id": i, "v": json.dumps(odd_value(rng)), "w": odd_value(rng)} for i in range(n)]
        for item in items:
            item["w"] = {"x": json.dumps(item["w"]), "y": [["[", item["v"]], [","]]}
        for indent in (None, 1):
            if root is None:
                yield json.dumps(items, indent=indent, ensure_ascii=rng.random() < 0.5)
                continue
            members = [("a,b", odd_value(rng)), (root, items), ('["', {"z": [1, 2, {root: []}]})]
            rng.shuffle(members)
            yield json.dumps(dict(members), indent=indent)


def broken(rng, text):
    """What an unfinished or spoilt file looks like."""
    yield text[: len(text) // 2]
    yield text + ","
    yield text + " x"
    yield text + "]"
    yield text.replace("}", "", 1)
    yield text.replace('"id": 0', '"id": 0,', 1)
    yield text.rstrip()[:-1] + ", ]"


@pytest.mark.parametrize("root, size", [(None, 1000), ("rows", 4000)])
def test_json_documents_over_blocks(spark, small_blocks, tmp_path, root, size):
    """Documents cut into elements give the rows and the bad documents that they give in one piece."""
    rng = random.Random(size)
    texts = list(documents_of(rng, root))
    texts += [t for text in texts[2:9:2] for t in broken(rng, text)]
    texts += ['{"q": [1, 2, 3, 4, 5, 6, 7, 8, 9]}', '{"rows": {"id": 5, "v": "one, two"}}', '{"rows": [{"id": 1}], "rows": [{"id": 7, "v": "last"}]}', '"just, a string, of some length"']
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    layout = T._parse_datatype_string("id bigint, v string, w struct<x: string, y: array<array<string>>>")

    def scan(session):
        parts = split(files.json_scan(session, str(tmp_path), root=root, layout=layout))
        good = sorted((r.source_name, r.id, r.v, str(r.w)) for r in parts.valid.collect())
        return good, sorted(r.source_name for r in parts.invalid.collect())

    whole, cut = scan(spark), scan(small_blocks(size))
    assert cut[0] == whole[0] and len(whole[0]) > 200
    assert cut[1] == whole[1]


def test_a_bad_document_shows_where_it_is_wrong(small_blocks, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2 "b": 3}' + ', {"a": 4}' * 200 + "]")
    (tmp_path / "b.json").write_text('[{"a": 1}' + ', {"a": 2}' * 200 + ', {"a": 4}')
    parts = split(files.json_scan(small_blocks(800), str(tmp_path), layout=T._parse_datatype_string("a bigint")))
    assert parts.valid.count() == 0
    assert {r.source_name[-6:]: r.error_record for r in parts.invalid.collect()} == {"a.json": ', {"a": 2 "b": 3}', "b.json": ', {"a": 4}'}


def test_no_task_reads_a_large_document_whole(small_blocks, tmp_path):
    text = json.dumps([{"id": i, "text": 'a "quoted", [odd] \\ text'} for i in range(2000)])
    (tmp_path / "a.json").write_text(text)
    rows = split(files.json_scan(small_blocks(4096), str(tmp_path), layout=T._parse_datatype_string("id bigint"))).valid
    assert rows.rdd.getNumPartitions() >= 8
    assert rows.selectExpr("count(*)", "sum(id)").first() == (2000, 1999000)


def test_blocks_may_be_smaller_than_the_splits_of_the_session(spark, tmp_path):
    rows = [[str(i), f"a\nb {i}" if i % 3 else f"c {i}"] for i in range(5000)]
    write_csv(tmp_path / "a.csv", [["id", "x"], *rows], random.Random(7))
    found = split(delimited.delimited_scan(spark, str(tmp_path), multi_line=True, markers=(), block_bytes=100))
    assert found.invalid.count() == 0
    assert sorted((r.id, r.x) for r in found.valid.select("id", "x").collect()) == sorted(map(tuple, rows))
    # Many blocks make no more tasks than there is work for; what is made of them is not cut like the file.
    assert (tmp_path / "a.csv").stat().st_size > 500 * 100
    assert 8 < found.valid.rdd.getNumPartitions() < 100
    assert found.valid.sparkSession.conf.get("spark.sql.files.maxPartitionBytes") != "100b"


def test_facts_of_blocks_are_one_file_for_many_blocks(spark, tmp_path, monkeypatch):
    kept, keep = [], delimited.keep
    monkeypatch.setattr(delimited, "keep", lambda *given: kept.append(keep(*given)) or kept[-1])
    write_csv(tmp_path / "a.csv", [["id", "x"], *([str(i), "a\nb"] for i in range(3000))], random.Random(8))
    delimited.delimited_scan(spark, str(tmp_path), multi_line=True, block_bytes=200)
    assert len(kept) == 1 and kept[0].count() > 100 and len(kept[0].inputFiles()) <= 8


@pytest.mark.parametrize("blank", ["", " "])
def test_first_lines_of_a_large_file(spark, tmp_path, monkeypatch, blank):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f"about\n{blank}\n{blank}\nid,x\n" + "1,2\n" * (60_000 if name == "a" else 3))
    monkeypatch.setattr(delimited, "_SMALL_FILE", 1000)
    heads = delimited.file_heads(spark, str(tmp_path), 2)
    assert [r.lines for r in heads.orderBy("path").collect()] == [["about", blank, None, "id,x"], ["about", blank, blank, "id,x"]]
    read = heads.select("path")._jdf.queryExecution().executedPlan().toString()
    assert "LocalLimit" in read
    rows = split(delimited.delimited_scan(spark, str(tmp_path), skip_rows=1, extra_columns=0)).valid
    assert rows.count() == 60_003 and rows.columns[:2] == ["id", "x"]


def test_elements_of_blocks_smaller_than_the_splits_of_the_session(spark, tmp_path, monkeypatch):
    from weirgate.sources import elements

    made, keep = [], elements.keep
    monkeypatch.setattr(elements, "keep", lambda *given: made.append(keep(*given)) or made[-1])
    rows = [{"id": i, "x": f"],{i}" if i % 3 else "\"[" * (i % 50)} for i in range(3000)]
    (tmp_path / "a.json").write_text(json.dumps({"more": [1], "rows": rows}))
    found = split(files.json_scan(spark, str(tmp_path), root="rows", block_bytes=300))
    assert found.invalid.count() == 0
    assert sorted((r.id, r.x) for r in found.valid.select("id", "x").collect()) == [(r["id"], r["x"]) for r in rows]
    facts = next(m for m in made if "begins_inside" in m.columns)
    assert facts.count() > 200 and all(len(m.inputFiles()) <= 40 for m in made)
