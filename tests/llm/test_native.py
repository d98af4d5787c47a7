"""Sharding, line and exact deduplication, decontamination and URL filters: SQL, brute force and odd rows."""
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from phenolens.llm import decontamination, exact_dedup, line_dedup, queries, sharding, url_filters

from conftest import SF

PYTHON_NODES = ("Python", "Pandas", "Arrow")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF['0.001']}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF["0.001"])
    res = duck.execute(queries.ORACLE[name])
    columns = sorted(d[0] for d in res.description)
    assert sorted(df.columns) == columns
    want = [dict(zip([d[0] for d in res.description], r)) for r in res.fetchall()]
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == sorted(repr([r[c] for c in columns]) for r in want)


@pytest.mark.parametrize("name", ["op2_sharding", "op3_line_dedup", "op5_exact_dedup", "op9_decontamination"])
def test_no_python_in_the_plan(spark, name):
    plan = queries.QUERIES[name](spark, SF["0.001"])._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PYTHON_NODES) and "CartesianProduct" not in plan


# ------------------------------------------------------------------ sharding

def jump(key, n):
    key, b, j = key & (1 << 64) - 1, -1, 0
    while j < n:
        b, key = j, (key * sharding.MULTIPLIER + 1) & (1 << 64) - 1
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_function(spark):
    keys = [0, 1, 2, 7, 12345, (1 << 63) - 1, -1, -(1 << 63), 987654321987654321]
    df = spark.createDataFrame([(k,) for k in keys + list(range(100, 400))], "k long")
    for n in (1, 2, 8, 9, 100):
        for r in df.withColumn("s", sharding.jump_hash(sharding.F.col("k"), n)).collect():
            assert r["s"] == jump(r["k"], n)


def test_sharding_query(spark):
    rows = queries.QUERIES["op2_sharding"](spark, SF["0.01"]).collect()
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, SF["0.01"]).collect()}
    slots = defaultdict(list)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert r["shard"] == jump(r["doc_id"], 8) and r["grown_shard"] in (r["shard"], 8)
        assert r["grown_shard"] == jump(r["doc_id"], 9)
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_odd_rows(spark, docs_of):
    rows = sharding.shard_documents(docs_of([(None, "a"), (1, None), (1, None), (2, "x" * 10**6)]), 3).collect()
    assert len(rows) == 4 and sorted(r["size"] for r in rows) == [1, 1, 2, 10**6 + 1]
    assert sharding.shard_documents(docs_of([]), 3).collect() == []
    named = spark.createDataFrame([("a", "t"), (None, "t")], "doc_id string, text string")
    assert sharding.shard_documents(named, 1).select("shard").distinct().count() == 1


# --------------------------------------------------------------------- lines

def test_lines(spark, docs_of):
    line, other = "A line of more than twenty", "another line of that length"
    docs = [(1, f"{line}\nshort\n{line}"), (2, f"\t{line.upper()} \n"), (3, f"x\n{line}\nx\n {line}"), (4, other),
            (5, other), (6, None), (7, ""), (None, f"{line}\n\n{other}"), (8, "é" * 19), (9, "é" * 19), (10, "é" * 19),
            (11, f"{'y' * 25}\n" * 200), (12, f"z\n{'y' * 25}"), (13, "y" * 25)]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"])
           for r in line_dedup.dedup_lines(docs_of(docs)).collect()}
    assert got[1] == (3, 2, "short") and got[2] == (2, 1, "") and got[3] == (4, 0, docs[2][1])
    assert got[None] == (3, 2, "") and got[4] == (1, 1, "") and got[5] == (1, 0, other)
    assert got[6] == got[7] == (1, 0, "") and got[8] == (1, 0, "é" * 19)
    assert got[11] == (201, 200, "") and got[12] == (2, 1, "z") and got[13] == (1, 0, "y" * 25)


def test_lines_are_sorted_in_one_range_exchange(spark, docs_of, monkeypatch):
    """The ordered pass over (line, document, position) is in the plan, on the one exchange of the lines by range."""
    seen = {}
    real = line_dedup.shared_table
    monkeypatch.setattr(line_dedup, "shared_table", lambda df, name: seen.setdefault(name, real(df, name)))
    docs = docs_of([(i, "a line that all the documents hold\n" * 3 + f"a line of document number {i}") for i in range(40)])
    df = line_dedup.drop_bitmaps(docs)
    rows = df.collect()
    assert seen["frequent_lines"].count() > 0 and {r["n_dropped"] for r in rows} == {3} and len(rows) == 39
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange rangepartitioning") == 1 and "Window" in plan
    window = plan.index("Window")
    assert "Sort [h1" in plan[window:] and "hashpartitioning(h1" not in plan


def test_lines_of_repeated_ids(spark, docs_of):
    line = "a line that several rows hold"
    rows = line_dedup.dedup_lines(docs_of([(1, line), (1, line), (1, f"x\n{line}"), (2, line)])).collect()
    assert {r["n_dropped"] for r in rows} == {0}  # two ids alone
    rows = line_dedup.dedup_lines(docs_of([(1, line), (1, line), (1, f"x\n{line}"), (2, line), (3, line)])).collect()
    assert sorted(r["kept_text"] for r in rows) == ["", "", "", line, "x"]
    assert line_dedup.dedup_lines(docs_of([])).collect() == []


# --------------------------------------------------------------------- exact

def test_exact(spark, docs_of):
    docs = [(i, "hot") for i in range(60)] + [(100, None), (101, ""), (102, "a"), (102, "a"), (None, "b"), (None, "c"),
                                              (103, "c"), (104, "C"), (105, "x" * 500000)]
    for heavy in (1, 256):
        rows = exact_dedup.exact_dedup(docs_of(docs), heavy=heavy).collect()
        assert len(rows) == len(docs)
        groups = defaultdict(list)
        for r in rows:
            groups[r["text_sha256"]].append(r)
        assert set(groups) == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in docs}
        for members in groups.values():
            ids = [r["doc_id"] for r in members if r["doc_id"] is not None]
            assert {(r["keep_id"], r["group_size"]) for r in members} == {(max(ids, default=None), len(members))}
            assert [r["doc_id"] for r in members if r["kept"]] == [max(ids, default=None)]
    kept = exact_dedup.keep_one(docs_of(docs))
    assert Counter(r["text"] or "" for r in kept.collect()) == Counter({(t or ""): 1 for _, t in docs})
    assert kept.columns == docs_of(docs).columns
    assert exact_dedup.exact_dedup(docs_of([])).collect() == []


def test_kept_rows_keep_columns_of_any_name(spark):
    names = ["id", "digest", "n", "row", "__id", "__n", "doc_id", "text"]
    rows = [("i", "d", "n", 1, "u", "v", 1, "a"), ("i2", "d", "n", 2, "u", "v", 2, "a"), (None, None, "n", 3, "u", "v", 3, "b")]
    df = spark.createDataFrame(rows, "id string, digest string, n string, row int, __id string, __n string, doc_id long, text string")
    kept = exact_dedup.keep_one(df)
    assert kept.columns == names and sorted(map(tuple, kept.collect()), key=str) == sorted(rows[1:], key=str)


# ----------------------------------------------------------- decontamination

def test_decontamination(spark, docs_of):
    words = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame([(1, " ".join(words[:12])), (2, "Short, ITEM"), (3, None), (4, "!!"),
                                   (5, " ".join(words[2:30])), (6, "one"), (5, "é É")], "item_id long, text string")
    docs = [(1, "a b " + "-".join(words[:10]) + " c"), (2, " ".join(words[:9])), (3, "a short item! shortitem"), (4, None),
            (5, ""), (None, "one"), (6, " ".join(words)), (7, " ".join(words[:10] + words[:10])), (8, "é É É é"), (9, "é é")]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in
           decontamination.decontaminate(docs_of(docs), items).collect()}
    assert got[1] == (13, 10, ["1"]) and got[2] == (9, 0, []) and got[3] == (4, 2, ["2"])
    assert got[4] == got[5] == (0, 0, []) and got[None] == (1, 1, ["6"])
    assert got[6] == (40, 30, ["1", "5"]) and got[7] == (20, 20, ["1"])
    assert got[8] == (4, 2, ["5"]) and got[9] == (2, 0, [])  # only A-Z are lower-cased
    clean = decontamination.clean(docs_of(docs), items)
    assert {r["doc_id"] for r in clean.collect()} == {2, 4, 5, 9} and clean.columns == docs_of(docs).columns
    assert decontamination.decontaminate(docs_of([]), items).collect() == []
    none = decontamination.decontaminate(docs_of(docs), items.limit(0)).collect()
    assert len(none) == len(docs) and not any(r["contaminated"] for r in none)


def test_a_shared_span_meets_in_a_fingerprint(spark, docs_of):
    """Spans of ten words at any place of a document and an item, among repeated words whose hashes tie."""
    import random
    rnd, docs, items, want = random.Random(5), [], [], {}
    for i in range(60):
        alphabet = ["a", "b"] if i % 2 else [f"x{j}" for j in range(60)]
        item = [rnd.choice(alphabet) for _ in range(rnd.randint(10, 30))]
        at = rnd.randint(0, len(item) - 10)
        doc = [f"d{rnd.randint(0, 99)}" for _ in range(rnd.randint(0, 20))] + item[at:at + rnd.randint(10, 30)] + ["end"] * (i % 3)
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(doc)))
    texts, spans = dict(docs), {}
    for i, text in items:
        w = text.split()
        spans[i] = {tuple(w[j:j + 10]) for j in range(len(w) - 9)}
    for d, text in docs:
        w = text.split()
        found = {(j, i) for j in range(len(w) - 9) for i in spans if tuple(w[j:j + 10]) in spans[i]}
        want[d] = (len({p for j, _ in found for p in range(j, j + 10)}), sorted({str(i) for _, i in found}))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontamination.decontaminate(docs_of(docs), table).collect()}
    assert got == want and all(n > 0 for n, _ in want.values())


def test_no_text_is_shuffled_with_a_fingerprint(spark, docs_of, monkeypatch):
    """Beyond a broadcast, documents' fingerprints are exchanged as (document, mark, place)."""
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plans, real = {}, decontamination.shared_table

    def kept(df, name):
        out = real(df, name)
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return out

    monkeypatch.setattr(decontamination, "shared_table", kept)
    text = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([(1, text), (2, text + " more")], "item_id long, text string")
    try:
        rows = decontamination.decontaminate(docs_of([(1, "x " + text), (2, None)]), items).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["doc_id"]: r["n_hit"] for r in rows} == {1: 40, 2: 0}
    for block in plans["alignments"].split("Exchange hashpartitioning(mark")[1:]:
        below = block.split("Exchange")[0]
        if "benchmark_fingerprints" not in below:
            assert "tokens" not in below.split("\n")[1] and "place" in below
    assert "SortMergeJoin" in plans["alignments"] and "BroadcastHashJoin" not in plans["alignments"]


# --------------------------------------------------------------- URL filters

def test_entries_active_at_fetch_time(spark):
    events = spark.createDataFrame([
        ("spam", "bad.example", False, 10, True), ("spam", "bad.example", False, 20, False),
        ("spam", "bad.example", False, 200, True), ("spam", "bad.example", False, 200, True),
        ("adult", "example", False, 15, True), ("ok", "bad.example/good/", True, 12, True),
        ("spam", "same.test", False, 5, True), ("spam", "same.test", False, 5, False),
        (None, "x.example", False, 1, True), ("spam", None, False, 1, True), ("spam", "y.example", False, None, True)],
        "list string, pattern string, allow boolean, day int, added boolean")
    urls = [(1, "http://bad.example/a", 9), (2, "http://bad.example/a", 10), (3, "https://u@WWW.Bad.example:80/a", 17),
            (4, "http://bad.example/good/x?y", 13), (5, "http://notbad.example", 20), (6, "http://bad.example", 300),
            (7, None, 12), (8, "http://bad.example", None), (9, "no url", 12), (10, "http://same.test/", 6),
            (None, "http://bad.example/goodish", 12), (2, "http://bad.example/a", 10), (11, "http://", 12),
            (12, "http://bad.example" + "/p" * 2000, 12)]
    captures = spark.createDataFrame(urls, "page_id long, url string, day int")
    rows = url_filters.judge(captures, events, period_days=7).collect()
    got = {r["page_id"]: (r["n_active"], r["lists"], r["allowed"]) for r in rows}
    assert len(rows) == len(urls)
    assert got[1] == (0, [], True) and got[2] == (1, ["spam"], False) and got[3] == (2, ["adult", "spam"], False)
    assert got[4] == (2, ["ok", "spam"], True) and got[5] == (1, ["adult"], False) and got[6] == (2, ["adult", "spam"], False)
    assert all(got[i] == (0, [], True) for i in (7, 8, 9, 10, 11))
    assert got[None] == (1, ["spam"], False) and got[12] == (1, ["spam"], False)
    assert url_filters.judge(captures.limit(0), events).collect() == []
    assert {r["n_active"] for r in url_filters.judge(captures, events.limit(0)).collect()} == {0}
