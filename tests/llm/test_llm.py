"""The operators of siltgate.llm against brute force, with nulls, ties, repeats and empty tables."""

import itertools
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

import check_queries
from siltgate.llm import (
    graph,
    html_text,
    mixing,
    packing,
    shards,
    simhash,
    small_world,
    toxicity,
    transcripts,
    tree_index,
    url_rules,
)
from siltgate.llm import queries  # noqa: F401
from siltgate.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# Extra columns carry names the operators use themselves.
DOCS = "doc_id bigint, text string, source string, lang string, n_chars bigint, size int, row int, fp string, score int, id int"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [
    None,
    "",
    "  \n ",
    "one",
    "One  TWO\tthree",
    "the same words again and again and again",
    "the same words again and again and again",
    "the same words  again and again and AGAIN",
    LONG,
    LONG + " tail",
    "you idiot, what a clown",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 2}", "en", 0, 1, 2, "x", 3, 4) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "one", "s1", "en", 0, 1, 2, "x", 3, 4)]  # a repeated row, a null id
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- components -------------------------------------------------------------------


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    edges += [(500 + i, 501 + i) for i in range(40)] + [(900, 900 + i) for i in range(60)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {n: find(n) for n in parent}
    assert all(got.get(n, n) == root for n, root in want.items())
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- op1 ----------------------------------------------------------------------------


def plain_fingerprint(text):
    found = [w.encode() for w in words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    shingles = [b" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(spark, docs, no_docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS) + 2
    marks = {r["doc_id"]: r["fp"] & (2**64 - 1) for r in got if r["doc_id"] is not None}
    assert marks == {i: plain_fingerprint(t) for i, t in enumerate(TEXTS)}
    comp = {r["doc_id"]: r["component_id"] for r in got}
    assert comp[0] == comp[1] == comp[2] == 0 and comp[5] == comp[6] == comp[7] == 5 and comp[None] == 3
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("bucket,halves", [(1024, True), (12, True), (3, True), (1, True), (1024, False), (3, False)])
def test_links_connect_all_near_fingerprints(spark, bucket, halves):
    rng = np.random.default_rng(5)
    values = {0}
    for base in rng.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(14):
            value = base
            for bit in rng.integers(0, 64, int(rng.integers(0, 5))).tolist():
                value ^= 1 << bit
            values.add(value)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    linked = simhash.links(frame, 4, halves, bucket)
    assert linked.where("bit_count(a ^ b) > 4").count() == 0
    got = {r["node"]: r["root"] for r in graph.components(linked).collect()}
    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
            assert got.get(a, a) == got.get(b, b)  # a root has no row of its own


# --- op2, op10 ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(260, 8))
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(base)]
    rows += [(300 + i, [float(x) for x in base[3] + rng.normal(size=8) * 0.05], 1) for i in range(40)]
    rows += [(400 + i, rows[100][1], 1) for i in range(30)]  # copies
    rows += [(450, [2 * x for x in rows[100][1]], 1), (100, rows[100][1], 1)]  # scaled, repeated
    bad = [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7]
    rows += [(500 + 50 * i, v, 1) for i, v in enumerate(bad)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, class int")


def good_rows(vectors):
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    rows = [(i, np.array(v, dtype=float)) for i, v in rows if v and None not in v]
    rows = [(i, v / np.linalg.norm(v)) for i, v in rows if np.isfinite(v).all() and v.any()]
    return [i for i, _ in rows], np.stack([v for _, v in rows])


def test_nearest(spark, vectors):
    got = {}
    for r in tree_index.nearest(vectors).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    ids, rows = good_rows(vectors.dropDuplicates(["vec_id"]))
    hits = total = 0
    for place, i in enumerate(ids):
        if i % 50:
            assert i not in got
            continue
        scores = rows @ rows[place]
        want = sorted((-round(float(s), 12), j) for s, j in zip(scores, ids) if j != i)[:5]
        assert sorted(got[i]) == [1, 2, 3, 4, 5]
        found = [got[i][k][0] for k in range(1, 6)]
        assert [got[i][k][1] for k in range(1, 6)] == sorted((got[i][k][1] for k in range(1, 6)), reverse=True)
        for vec, score in got[i].values():
            assert abs(score - scores[ids.index(vec)]) < 1e-9
        hits, total = hits + len(set(found) & {j for _, j in want}), total + 5
    assert hits >= 0.9 * total
    assert tree_index.nearest(vectors.where("false")).count() == 0
    assert tree_index.nearest(vectors.where("vec_id = 50")).count() == 0


def test_embedding_near_duplicates(spark, vectors):
    got = small_world.near_duplicates(vectors).collect()
    assert len(got) == vectors.count()
    ids, rows = good_rows(vectors)
    near = rows @ rows.T >= 0.9
    np.fill_diagonal(near, False)
    want = sorted((i, int(n)) for i, n in zip(ids, near.sum(axis=1)))
    bad = {500, 550, 600, 650, 700, 750}
    assert sorted((r["vec_id"], r["n_links"]) for r in got if r["vec_id"] not in bad) == want
    assert all(r["n_links"] == 0 and r["kept"] and r["component_id"] == r["vec_id"] for r in got if r["vec_id"] in bad)
    reach = near | np.eye(len(ids), dtype=bool)
    for _ in range(10):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    least = {i: min(j for j, hit in zip(ids, row) if hit) for i, row in zip(ids, reach)}
    assert all(r["component_id"] == least[r["vec_id"]] for r in got if r["vec_id"] in least)
    assert small_world.near_duplicates(vectors.where("false")).count() == 0


@pytest.mark.parametrize("copies", [1, 500])
def test_links_the_graphs_lose_are_still_found(spark, monkeypatch, copies):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1_200, 24))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(2_000 + i, [float(x) for x in base[i] + 0.05 * rng.normal(size=24)]) for i in range(copies)]
    found = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    pairs = small_world._pairs
    monkeypatch.setattr(small_world, "_pairs", lambda *a: pairs(*a).where("false"))
    monkeypatch.setattr(small_world, "WIDEST", small_world.BEAM)
    monkeypatch.setattr(small_world, "AUDIT", 100)
    ids, unit = good_rows(found)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = small_world.near_duplicates(found).collect()
    assert sorted((r["vec_id"], r["n_links"]) for r in got) == sorted((i, int(n)) for i, n in zip(ids, near.sum(axis=1)))
    assert {r["vec_id"]: r["component_id"] for r in got}[2_000] == 0


def test_recall_is_measured_by_vector(spark):
    large = [(a, b) for a in range(30) for b in range(30) if a != b]
    small = [(100 + i, 100 + (i ^ 1)) for i in range(10)]
    wanted = spark.createDataFrame(large + small, "own bigint, other bigint")
    pairs = spark.createDataFrame([p for p in large + small[:4] if p[0] < p[1]], "a bigint, b bigint")
    assert abs(small_world._measured(wanted, pairs) - 0.4) < 1e-9


# --- op3 ------------------------------------------------------------------------------


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        all_ = sum(weight[s] for s in sizes if s not in capped)
        share = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / all_ for s in sizes}
        over = {s for s in sizes if s not in capped and share[s] > 2 * sizes[s]}
        if not over:
            return share
        capped |= over


def test_mixing(spark, docs, no_docs):
    big = spark.range(3000).selectExpr(
        "id as doc_id", "repeat('word ', cast(1 + id % 37 as int)) as text", "case when id % 7 = 0 then null when id % 3 = 0 then 'hot' else concat('s', id % 11) end as source"
    )
    rows = mixing.mix(big).collect()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = plain_targets(sizes)
    assert len(rows) == 3000 and all(abs(target[s] - want[s]) < 1e-6 * want[s] for s in want)
    assert all(abs(taken[s] - want[s]) <= 2 for s in want)
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(big.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in rows}
    few = mixing.mix(docs).collect()
    assert len(few) == len(TEXTS) + 2 and mixing.mix(no_docs).count() == 0
    by_id = {r["doc_id"]: r["size"] for r in few if r["doc_id"] is not None}
    assert by_id == {i: len(words(t)) for i, t in enumerate(TEXTS)}


def test_quotas_are_highest_quotients(spark):
    goals = spark.createDataFrame([("a", 900, 53.0), ("b", 900, 24.0), ("c", 900, 23.0)], "source string, source_size bigint, target double")
    got = {(r["source"], r["shard"]): r["blocks"] for r in mixing.quotas(goals, seats=10, shards=2).collect()}
    quotients = sorted(((t / (2 * k + 1), s) for s, t in (("a", 53), ("b", 24), ("c", 23)) for k in range(12)), reverse=True)[:10]
    for shard in (0, 1):
        part = [s for _, s in quotients[5 * shard : 5 * shard + 5]]
        assert {s: got.get((s, shard), 0) for s in "abc"} == {s: part.count(s) for s in "abc"}


def test_mix_takes_sources_smaller_than_a_block(spark):
    rows = [(i, "word " * 100, "big") for i in range(400)] + [(900, "one two three", "tiny"), (901, "four words in here", None)]
    rows += [(1000 + i, "a b c d e", f"site{i}") for i in range(40)]
    found = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken, sizes = {}, {}
    for r in mixing.mix(found, seats=20).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = plain_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want) and taken["tiny"] == 6 and taken[None] == 8
    assert sum(taken.values()) == int(1.5 * sum(sizes.values()) + 0.5)


@pytest.mark.parametrize("seats,shards", [(40, 4), (100_000, 4), (3, 1)])
def test_mix_draws_blocks_as_a_plain_loop_does(spark, seats, shards):
    docs = spark.range(400).selectExpr(
        "id as doc_id", "repeat('word ', cast(id * 7 % 23 as int)) as text",
        "case when id % 5 = 0 then null when id % 3 = 0 then 'hot' else concat('s', id % 7) end as source",
    )
    rows = [r.asDict(recursive=True) for r in mixing.mix(docs, seats=seats, shards=shards).collect()]
    goals = spark.createDataFrame(
        [(s, n, t) for s, n, t in {(r["source"], r["source_size"], r["target"]) for r in rows}],
        "source string, source_size bigint, target double",
    )
    block = mixing.block_size(goals, seats)
    quota = {(r["source"], r["shard"]): r["blocks"] for r in mixing.quotas(goals, seats, shards).collect()}
    drawn = {r["source"]: r["drawn"] for r in mixing.words_given(goals).collect()}
    for source, words_drawn in drawn.items():
        mine = sorted((r for r in rows if r["source"] == source), key=lambda r: r["row"] % (1 << 64))
        start, blocks = 0, {}
        for r in mine:
            if r["size"]:
                blocks.setdefault(start // block, []).append(r)
            start += r["size"]
        cells = [(source, b, p) for b in blocks for p in (0, 1)]
        marked = spark.createDataFrame(cells, "source string, block bigint, pass int").select(
            "block", "pass", F.xxhash64(F.lit(mixing.SEED), "source", "block", "pass").alias("h")
        )
        order = sorted(marked.collect(), key=lambda m: (m["pass"], m["h"], m["block"]))
        seats_of = [shard for shard in range(shards) for _ in range(quota.get((source, shard), 0))]
        expected, left = {id(r): [] for r in mine}, words_drawn
        for rank, m in enumerate(order):
            for r in blocks[m["block"]]:
                n = min(left, r["size"])
                if n:
                    expected[id(r)].append({"shard": seats_of[rank] if rank < len(seats_of) else rank % shards, "words": n})
                left -= n
        assert left == 0
        assert all(r["shards"] == expected[id(r)] and r["taken"] == sum(e["words"] for e in r["shards"]) for r in mine)


def test_seats_and_shards_decide_the_mix(spark):
    docs = spark.range(600).selectExpr("id as doc_id", "repeat('word ', 5) as text", "concat('s', id % 3) as source")

    def taken(**options):
        return {r["doc_id"]: (r["taken"], tuple(r["shards"])) for r in mixing.mix(docs, **options).collect()}

    few, many = taken(seats=20, shards=4), taken(seats=500, shards=4)
    assert {i: t for i, (t, _) in few.items()} != {i: t for i, (t, _) in many.items()}
    assert few != taken(seats=20, shards=2) and few == taken(seats=20, shards=4)


def test_words_given_are_highest_quotients(spark):
    rng = np.random.default_rng(4)
    sizes = {f"s{i:03}": int(n) for i, n in enumerate(rng.integers(1, 9, 150))} | {"z": 700}
    share = {s: float(rng.uniform(0.2, 1.9)) * n for s, n in sizes.items()}
    goals = spark.createDataFrame([(s, sizes[s], share[s]) for s in sizes], "source string, source_size bigint, target double")
    got = {r["source"]: r["drawn"] for r in mixing.words_given(goals).collect()}
    total = int(sum(share.values()) + 0.5)
    quotients = sorted((-share[s] / (2 * k + 1), s) for s in sizes for k in range(2 * sizes[s]))[:total]
    assert got == {s: sum(q[1] == s for q in quotients) for s in sizes}


# --- op4 ------------------------------------------------------------------------------


def test_html(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav>"
        "<div id=main><h1>Head</h1><p>One, two,\n three &amp; four, with some more words to count.<p>Five, <b>six</b> &lt;seven&gt;, eight."
        "<script>var x='</p><p>no';</script></div><div class='comments'><p>A reader, with, many, commas, writes, a, lot, here</p></div>"
        "<aside>Side</aside><form>Name</form><footer>&copy; Foot</footer>"
    )
    assert html_text.main_text(page) == "Head\nOne, two, three & four, with some more words to count.\nFive, six <seven>, eight."
    frame = spark.createDataFrame(
        [(1, "u", None, "x"), (2, "u", "", "x"), (3, "u", "<p>" + "long text, " * 20_000, "x"), (3, None, "<div><<p>odd</div", "x")],
        "page_id bigint, url string, html string, text string",
    )
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in html_text.extract(frame).collect()}
    assert got[(1, "u")] == ("", 0) and got[(2, "u")] == ("", 0)
    assert got[(3, "u")][1] == len("long text, " * 20_000) - 1
    assert "odd" in got[(3, None)][0]
    assert html_text.extract(frame.where("false")).count() == 0


PROSE = "One paragraph, with commas, and with enough words in it to count as the text of a page. " * 3


def test_html_names_are_doubts_only():
    text = PROSE.strip()
    assert html_text.main_text(f'<div class="content has-sidebar"><article><p>{PROSE}</article></div>') == text
    assert html_text.main_text(f'<div class="elementor-widget-container"><p>{PROSE}</div><div class=widget>Shop, now, here</div>') == text
    assert html_text.main_text(f'<div class="widget"><p>{PROSE}</div>') == text
    page = f'<article><h1 class="entry-header">Head</h1><p>{PROSE}<section class="related-work"><p>{PROSE}</section></article>'
    assert html_text.main_text(page) == f"Head\n{text}\n{text}"
    page = f'<div id=c><p>{PROSE}<p>{PROSE}<div class="sharing">Share it</div><div class="social-links"><a href="/">Follow</a></div></div>'
    assert html_text.main_text(page) == f"{text}\n{text}"


def test_html_keeps_what_stands_beside_the_best():
    text = PROSE.strip()
    page = (
        f"<div id=content><section><p>{PROSE}<p>{PROSE}<p>{PROSE}</section>bare <b>text</b><section><p>A short one.</section><h3>Points</h3>"
        "<ul><li>red<li>green</ul><blockquote>Said so.</blockquote><table><tr><td>cell</table></div><nav><a href=/>Home</a></nav>"
    )
    want = [text, text, text, "bare text", "A short one.", "Points", "red", "green", "Said so.", "cell"]
    assert html_text.main_text(page).split("\n") == want


def test_html_reads_on_after_foreign_elements():
    text = PROSE.strip()
    for odd in ("<svg width=1/ />", "<svg/>", "<svg><g><path d=''/></g></svg>", "<svg><path>", "<template/>", "<noscript><p>Enable it</noscript>", "<iframe src='x'/>", "<iframe>"):
        assert html_text.main_text(f"<article><p>{PROSE}</p>{odd}<p>{PROSE}</p></article>") == f"{text}\n{text}", odd
    assert html_text.main_text(f"<article><p>{PROSE}<math><mi>x</mi></math></p></article>") == f"{text} x"


# --- op5 ------------------------------------------------------------------------------


def test_transcripts(spark):
    conversations = spark.createDataFrame(
        [(c, t, ("user", "assistant")[t % 2], f"line {c} {t}\nmore of it") for c in range(60) for t in range(6)]
        + [(99, 0, "user", None), (99, None, None, "x"), (None, 0, "user", "y")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    lines = transcripts.from_turns(conversations).persist()
    numbers = lines.groupBy("conv_id").agg(F.count("*").alias("n"), F.max("line_no").alias("last"), F.countDistinct("line_no").alias("d"))
    assert numbers.where("last <> n - 1 or d <> n").count() == 0
    model = transcripts.train(lines)
    whole = transcripts.recover(lines, model)
    parted = transcripts.recover(lines, model, block=2)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parted.collect()))
    both = lines.join(whole.withColumnRenamed("role", "got").drop("line", "begins"), ["conv_id", "line_no"])
    assert both.where("role is not null").agg(F.avg(F.expr("cast(role = got as int)"))).first()[0] > 0.85
    turns = transcripts.turns(whole).where("conv_id = 0").orderBy("turn").collect()
    assert [t["turn"] for t in turns] == list(range(len(turns)))
    assert transcripts.turns(transcripts.recover(lines.where("false"), model)).count() == 0


# --- op6 ------------------------------------------------------------------------------


def test_packing(spark, docs, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    odd = spark.createDataFrame([(100, "a.b, it's <|endoftext|> É. İx 3.5, (x). don't.", "s")], "doc_id bigint, text string, source string")
    pieces = packing.tokenized(docs.select("doc_id", "text", "source").unionAll(odd)).collect()
    texts = {**dict(enumerate(TEXTS)), 100: odd.first()["text"]}
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        got = sorted({(p["piece"], p["start"], p["length"], bytes(p["ids"]), p["ids_crc32"]) for p in pieces if p["doc_id"] == doc})
        data = np.array(ids, dtype="<u4").tobytes()
        cut = [data[i : i + 8192] for i in range(0, len(data), 8192)]
        assert got == [(i, 2048 * i, len(c) // 4, c, zlib.crc32(c)) for i, c in enumerate(cut)]
    packed = packing.pack_documents(docs).collect()
    assert len(packed) == sum(p["doc_id"] != 100 for p in pieces)
    assert packing.pack_documents(no_docs).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_limit(spark, rule):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 4000)
    frame = spark.createDataFrame([(int(n),) for n in lengths], "length bigint")
    limits = packing.Limits(tokens=100, documents=5, attention=10_000, rule=rule)
    rows = packing.pack(frame, limits, group=700).collect()
    assert sorted(r["length"] for r in rows) == sorted(lengths.tolist())
    found = {}
    for r in rows:
        found.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in found.values():
        places.sort()
        assert [o for o, _ in places] == [0, *itertools.accumulate(n for _, n in places)][:-1]
        assert sum(n for _, n in places) <= 100 and len(places) <= 5 and sum(n * n for _, n in places) <= 10_000
    assert len(found) <= 1.03 * lengths.sum() / 100 + 1


# --- op7 ------------------------------------------------------------------------------


def test_url_rules(spark):
    rules = url_rules.rules_frame(spark, queries.URL_RULES)
    urls = {
        "http://a.example.com/en/x?q=/es/": ("block", "example.com/en/"),
        "https://www.EXAMPLE.com/en/": ("allow", "www.example.com/en/"),
        "https://m.www.example.com/en/1": ("allow", "www.example.com/en/"),
        "https://notexample.com/en/1": ("allow", "com/"),
        "https://x.net/fr/1": ("block", "net/fr/"),
        "https://x.net/frx/1": ("allow", None),
        "https://example.com?x": ("allow", None),
        "no scheme example.com/en/": ("allow", None),
        "": ("allow", None),
        None: ("allow", None),
    }
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate([*urls, "https://x.net/fr/1"])], "page_id int, url string, rule string")
    got = url_rules.judge(pages, rules).collect()
    assert len(got) == len(urls) + 1
    assert all((r["verdict"], r["rule"]) == urls[r["url"]] for r in got)
    assert url_rules.judge(pages.where("false"), rules).count() == 0
    assert url_rules.judge(pages, rules.where("false")).where("verdict <> 'allow'").count() == 0


def test_url_rules_with_dots_and_clashing_columns(spark):
    """Rules with dots, escapes and ports; page columns named like those inside."""
    rules = url_rules.rules_frame(spark, [("block", "example.com/v1.0/x"), ("block", "a.net:80/q%20/")])
    urls = {
        "http://example.com/v1.0/x1": "block",
        "http://example.com/v1.1/x1": "allow",
        "http://w.example.com/v1.0/x/y": "block",
        "http://a.net:80/q%20/z": "block",
        "http://a.net/q%20/z": "allow",
    }
    rows = [(u, "b", "u", "j", "p", "t") for u in urls]
    pages = spark.createDataFrame(rows, "url string, best string, _url string, judged string, page string, token string")
    got = url_rules.judge(pages, rules)
    assert got.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert {r["url"]: r["verdict"] for r in got.collect()} == urls
    assert got.where("best = 'b' and _url = 'u' and judged = 'j' and page = 'p' and token = 't'").count() == len(urls)


# --- op8 ------------------------------------------------------------------------------


def test_shards(spark, docs, no_docs):
    big = spark.range(5000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'copy of a text' else repeat('é', cast(id % 90 as int)) end as text")
    rows = shards.shard(big, 40, part_rows=300).collect()
    assert len(rows) == 5000
    total = sum(r["size"] for r in rows)
    for shard in range(40):
        part = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / 40) <= 200
    few = shards.shard(docs).collect()
    assert len(few) == len(TEXTS) + 2 and shards.shard(no_docs).count() == 0
    for r in few:
        if r["doc_id"] is not None:
            data = (TEXTS[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))


# --- op9 ------------------------------------------------------------------------------


def test_toxicity(spark, no_docs):
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(["ti", "on", "the", "re", "la", "mo"], 3)) for _ in range(80)]
    rows, marks = [], []
    for i in range(400):
        text = rng.choice(plain, 12).tolist()
        if i % 4 == 0:
            text[3] = ("idiot", "scumbag")[i % 8 == 0]
        rows.append((i, " ".join(text)))
        marks.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out())
    assert got.where("predicted <> toxic").count() == 0
    tried = ["an idi-ot here", "an i.d.iot", "i d i o t", "the only motion", "", None, "x" * 100_000]
    more = spark.createDataFrame([(i, t) for i, t in enumerate(tried)], "doc_id bigint, text string")
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score(more, model).collect()}
    assert scores[0] == 1 and scores[2] == 1 and [scores[i] for i in (3, 4, 5, 6)] == [0, 0, 0, 0]
    assert toxicity.score(no_docs, model).count() == 0
    blank = toxicity.train(docs, labels.where("toxic = 0"))
    assert toxicity.score(docs, blank).where("predicted = 1").count() == 0


def test_toxicity_beyond_single_words(spark):
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(["ti", "on", "the", "re", "la", "mo"], 3)) for _ in range(80)]
    rows, marks = [], []
    for i in range(600):
        text = rng.choice(plain, 12).tolist()
        if i % 4 == 0:
            text[3:5] = (["idiot"], ["scumbag"], ["gonna", "hurt"])[i % 3]
        elif i % 4 == 1:
            text[i % 9] = ("gonna", "hurt")[i % 8 == 1]
        rows.append((i, " ".join(text)))
        marks.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    bad = ["an i.d.iot", "the idi ot", "the id iot", "an id i ot", "i--d--i--o--t", "they gonna hurt"]
    fine = ["the only motion", "they gonna leave", "it may hurt", "it is on the"]
    texts = spark.createDataFrame(list(enumerate(bad + fine)), "doc_id int, text string")
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score(texts, model).collect()}
    assert [scores[i] for i in range(len(scores))] == [1] * len(bad) + [0] * len(fine)
    assert toxicity.windows("ass,") and toxicity.windows("fu")


def test_folded_weights_are_the_kernel():
    strings = ["idiot", "id-iot", "another", "xyz", "ididid"]
    marks = ["idiot", "other"]
    row, code, value = toxicity.subsequences(marks)
    weights = np.array([2.0, -1.0])
    codes, place = np.unique(code, return_inverse=True)
    model = toxicity.Model(codes, np.bincount(place, value * weights[row]), 0.0)
    assert np.allclose(model.sums(strings), toxicity.kernel(strings, marks) @ weights, atol=1e-5)


# --- queries --------------------------------------------------------------------------


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    count, difference = check_queries.compare(spark, check_queries.duck(SF), SF, QUERIES[name], ORACLES[name])
    assert count and not difference


def test_simhash_query(spark):
    texts = dict(duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op1_simhash"](spark, SF).collect()}
    marks = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {i: f"{m:016x}" for i, m in marks.items()} == {i: f for i, (f, _) in got.items()}
    least = {i: i for i in marks}
    while True:  # every pair, until nothing moves
        moved = {
            i: min(least[j] for j, other in marks.items() if (mark ^ other).bit_count() <= 4) for i, mark in marks.items()
        }
        if moved == least:
            break
        least = moved
    assert {i: c for i, (_, c) in got.items()} == least


def test_a_large_group_of_near_copies_is_one_component(spark):
    rng = np.random.default_rng(2)
    masks = [sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(3000)]
    values = sorted({v - 2**64 if v >= 2**63 else v for v in (0x5DEECE66D1234567 ^ m for m in masks)})
    frame = spark.createDataFrame([(v,) for v in values], "fp bigint")
    for bucket in (simhash.BUCKET, 100):
        roots = graph.components(simhash.links(frame, bucket=bucket)).collect()
        assert len(roots) == len(values) - 1 and len({r["root"] for r in roots}) == 1


def test_pipeline(spark, no_docs):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, SF).columns == docs.columns
    copies = docs.limit(20).persist()
    doubled = copies.unionAll(copies).unionAll(copies.withColumn("doc_id", F.lit(None).cast("bigint")))
    once = corpus_pipeline.drop_near_copies(spark, doubled, SF).collect()
    components = {r["root"] for r in simhash.near_duplicates(copies).collect()}
    assert len(once) == len(components) and all(r["doc_id"] is not None for r in once)
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    total = sum(len(words(r["text"])) for r in docs.collect())
    taken = sum(len(words(r["text"])) for r in mixed.collect())
    assert mixed.columns == docs.columns and abs(taken - 1.5 * total) <= 30
    assert corpus_pipeline.run(spark, SF).count() > 0
    schema = T.StructType(docs.schema.fields)
    empty = spark.createDataFrame([], schema)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, empty, SF).count() == 0


def test_pipeline_keeps_a_lone_null_id(spark):
    import corpus_pipeline

    rows = [(1, "some words of one text here", "s", "en", 1), (None, "nothing resembles this row at all", "s", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()} == {1, None}
