"""Example packing, vector codes and periodic runs against brute force and exact round trips."""

import hashlib
import itertools
import math
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest

import check_queries
from siltgate.llm import example_packing, periodic_runs, queries, toxicity, vector_codes
from siltgate.llm.example_packing import Limits, fill
from siltgate.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, prompt string, row int, at int, length int, runs int, sequence_id int, code string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [None, "", " \n\t ", "one", LONG, "a <|endoftext|> b", "ünïcödé 日本 \U0001f600", "x " * 4000, "the same words", "the same words"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, 1, 2, 3, 4, 5, "y") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [rows[9], (None, "one", None, 1, 2, 3, 4, 5, "y")], DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_periodic_runs"])
def test_query_matches_sql(spark, name):
    _, difference = check_queries.compare(spark, check_queries.duck(SF), SF, QUERIES[name], ORACLES[name])
    assert difference == ""


# --- packing --------------------------------------------------------------------


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_places(pieces, ids, limits, cut=True):
    """Every id once, gapless offsets, limits kept; returns sequence lengths."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc, whole in ids.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(whole)
            part = np.array(whole[at : at + p["length"]], dtype="<u4").tobytes()
            assert zlib.crc32(part) == p["ids_crc32"]
            at += p["length"]
        assert at == len(whole)
    lengths = []
    for inside in by_sequence.values():
        at = 0
        for p in sorted(inside, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limits.tokens and len(inside) <= limits.segments
        assert sum(p["length"] - 1 for p in inside) <= limits.loss
        lengths.append(at)
    return lengths


def test_query_packs_without_padding(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip([r["doc_id"] for r in rows], reference_ids([r["text"] for r in rows])))
    pieces = QUERIES["op11_example_packing"](spark, SF).collect()
    lengths = check_places(pieces, ids, Limits())
    assert sum(lengths) == sum(map(len, ids.values()))
    # No sequence is padded, all but a few are full, and few documents are cut beyond need.
    assert all(n & (n - 1) == 0 for n in lengths)
    assert sum(n < 1024 for n in lengths) <= 10
    assert len(pieces) <= sum(-(-len(i) // 1024) for i in ids.values()) + len(lengths)


def test_tokens_are_those_of_the_tokenizer_file(spark, docs):
    pieces = example_packing.tokenized(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    found = defaultdict(bytes)
    for p in sorted(pieces, key=lambda p: p["start"]):
        found[p["doc_id"]] += bytes(p["ids"])
    expected = reference_ids(TEXTS)
    assert [np.frombuffer(found[i], "<u4").tolist() for i in range(len(TEXTS))] == expected


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 64), Limits(64, 4, 20), Limits(1, 1, 1)])
def test_groups_and_levels_lose_nothing(spark, limits):
    random.seed(7)
    texts = [" ".join(random.choices("some words of a text".split(), k=random.randrange(90))) for _ in range(120)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ids = dict(enumerate(reference_ids(texts)))
    pieces = example_packing.pack_documents(frame, limits=limits, group=16).collect()
    lengths = check_places(pieces, ids, limits)
    assert all(n == limits.tokens or n & (n - 1) == 0 for n in lengths)
    again = example_packing.pack_documents(frame, limits=limits, group=16).collect()
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, again))


def test_nulls_repeats_and_clashing_names(spark, docs, no_docs):
    pieces = example_packing.pack_documents(docs).collect()
    n = sum(map(len, reference_ids(TEXTS + [TEXTS[9], "one"])))
    assert sum(p["length"] for p in pieces) == n
    assert sum(p["length"] for p in pieces if p["doc_id"] is None) == len(reference_ids(["one"])[0])
    assert sum(p["length"] for p in pieces if p["doc_id"] in (0, 1)) == 2
    assert example_packing.pack_documents(no_docs).count() == 0


def test_each_limit_binds():
    def packed(asks, limits, cut=False):
        pieces = [(i, 0, n, quiet) for i, (n, quiet) in enumerate(asks)]
        out = list(fill(pieces, limits, cut, last=True))
        for _, inside in out:
            assert sum(p[2] for p in inside) <= limits.tokens and len(inside) <= limits.segments
            assert sum(p[2] - p[3] for p in inside) <= limits.loss
        assert sum(p[2] for _, inside in out for p in inside) == sum(n for n, _ in asks)
        return out

    assert len(packed([(10, 1)] * 8, Limits(80, 8, 80))) == 1
    assert len(packed([(10, 1)] * 8, Limits(80, 4, 80))) == 2
    assert len(packed([(10, 1)] * 8, Limits(80, 8, 27))) == 3
    # Long prompts go with long answers: a rule by tokens alone would need a third sequence.
    mixed = [(50, 49)] * 2 + [(50, 1)] * 2
    assert len(packed(mixed, Limits(100, 8, 55))) == 2
    # What an empty sequence cannot hold is cut in any case.
    assert sum(len(inside) for _, inside in packed([(50, 1)], Limits(20, 8, 20))) == 3


def test_prompts_bear_no_loss_and_sequences_hold_the_ids(spark):
    rows = [(i, "answer " * (i % 7), "please say " * (i % 5)) for i in range(60)] + [(60, "x", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, prompt string")
    limits = Limits(64, 8, 24)
    packed = example_packing.pack_documents(frame, prompt_col="prompt", limits=limits, cut=False, with_ids=True)
    expected = {}
    for i, text, prompt in rows:
        expected[i] = reference_ids([prompt or ""])[0][:-1] + reference_ids([text])[0]
    made = example_packing.sequences(packed).collect()
    seen = defaultdict(list)
    for s in made:
        ids = np.frombuffer(bytes(s["ids"]), "<u4").tolist()
        for at, stop, piece in zip(s["segments"], [*s["segments"][1:], len(ids)], s["pieces"]):
            seen[piece["doc_id"]].append((piece["start"], ids[at:stop]))
        assert len(ids) <= 64 and len(s["segments"]) <= 8
        loss = 0
        for piece, at, stop in zip(s["pieces"], s["segments"], [*s["segments"][1:], len(ids)]):
            prompt = len(expected[piece["doc_id"]]) - len(reference_ids([rows[piece["doc_id"]][1]])[0])
            loss += max(0, stop - at - max(1, prompt - piece["start"]))
        assert loss <= 24
    assert {d: [x for _, part in sorted(parts) for x in part] for d, parts in seen.items()} == expected


# --- vector codes ---------------------------------------------------------------


def plain_codes(vectors, parts=8, entries=16, rounds=6, scale=4096):
    """The same rounds in plain Python, every part against every entry."""
    ints = [[math.floor(float(x) * scale) for x in v] for v in vectors]
    w = len(ints[0]) // parts
    cut = [[v[p * w : p * w + w] for p in range(parts)] for v in ints]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def near(part, book):
        found = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in book]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for v in cut:
                groups[near(v[p], books[p])[0]].append(v[p])
            for k, members in groups.items():
                books[p][k] = [sum(column) // len(members) for column in zip(*members)]
    codes = ["".join(f"{near(v[p], books[p])[0]:02x}" for p in range(parts)) for v in cut]
    errors = [sum(near(v[p], books[p])[1] for p in range(parts)) for v in cut]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return codes, errors, digest


@pytest.mark.parametrize("leaves", [2048, 3])
def test_codes_equal_plain_rounds(spark, monkeypatch, leaves):
    random.seed(3)
    # Few values a component, so that parts share prefixes and whole parts repeat.
    vectors = [[random.choice([-0.5, -0.0001, 0.0, 0.25, 1.0]) for _ in range(24)] for _ in range(300)]
    vectors += vectors[:40]
    codes, errors, digest = plain_codes(vectors)
    rows = [(i, v, i % 3 or None) for i, v in enumerate(vectors)]
    bad = [(1000, None, 1), (1001, [float("nan")] * 24, 1), (1002, [None] * 24, 1), (1003, [float("inf")] + [0.0] * 23, 2)]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>, label int").repartition(5)
    monkeypatch.setattr(vector_codes, "LEAVES", leaves)
    found = vector_codes.compress(frame)
    assert found.digest() == digest
    got = {r["id"]: r for r in vector_codes.with_label_errors(found.rows).collect()}
    assert [got[i]["code"] for i in range(len(vectors))] == codes
    assert [got[i]["error"] for i in range(len(vectors))] == errors
    sums = defaultdict(int)
    for (_, _, label), error in zip(rows, errors):
        sums[label] += error
    assert all(got[i]["label_error"] == sums[label] for i, _, label in rows)


@pytest.mark.parametrize("leaves", [1, 2, 7, 10_000])
def test_trie_distances_equal_plain_ones(monkeypatch, leaves):
    monkeypatch.setattr(vector_codes, "LEAVES", leaves)
    rng = np.random.default_rng(5)
    for width in (1, 2, 5):
        rows = np.unique(rng.integers(-3, 3, (200, width)), axis=0)
        book = rng.integers(-3, 3, (6, width))
        plain = ((rows[:, None, :] - book[None]) ** 2).sum(axis=2)
        found = np.empty_like(plain)
        covered = []
        for low, high, part in vector_codes.leaf_distances(rows, book):
            found[low:high] = part
            covered += range(low, high)
        assert covered == list(range(len(rows))) and (found == plain).all()


def test_codes_of_few_wide_and_uneven_vectors(spark):
    schema = "vec_id bigint, embedding array<double>, label string, code string, pos int, n int"
    assert vector_codes.compress(spark.createDataFrame([], schema)).rows.count() == 0
    few = [(2, [1e9, -1e9, 3.0], "a", "x", 1, 1), (1, [1e9, 0.0, 3.0], None, "x", 1, 1), (3, [1.0], "a", "x", 1, 1), (None, [0.0] * 3, None, "x", 1, 1)]
    found = vector_codes.compress(spark.createDataFrame(few + few[:1], schema))
    assert [len(book) for book in found.books] == [4] * 8
    rows = found.rows.collect()
    assert sorted((r["id"] or 0) for r in rows) == [0, 1, 2, 2]
    assert all(r["error"] == 0 for r in rows)
    first = next(r for r in rows if r["id"] == 1)
    assert np.allclose(vector_codes.decode(first["code"], found.books)[:3], [1e9, 0.0, 3.0], atol=1 / 4096)


# --- runs -----------------------------------------------------------------------


def plain_runs(words, shortest=12):
    """Every period and start tried: all stretches that cannot be made longer, smallest period first."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(shortest, 2 * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


@pytest.mark.parametrize("shortest", [2, 5, 12])
def test_runs_equal_brute_force(shortest):
    random.seed(11)
    texts = []
    for _ in range(400):
        kind = random.randrange(4)
        size = random.randrange(70)
        words = [random.choice("ab" if kind == 0 else "abcdefgh").encode() for _ in range(size)]
        if kind >= 2 and words:
            at, period = random.randrange(size), random.randrange(1, 12)
            words = words[:at] + (words[at : at + period] * 30)[: random.randrange(80)] + words[at:]
        texts.append(words)
    texts.append([b"x"] * 500)
    texts.append([b"x", b"y"] * 200 + [b"x"] * 30)
    found = periodic_runs.runs_of(texts, shortest)
    for words, runs in zip(texts, found):
        assert sorted(runs) == plain_runs(words, shortest)
        assert runs == sorted(runs, key=lambda r: (r[0], r[2]))


def test_runs_do_not_depend_on_blocks(spark, docs, no_docs, monkeypatch):
    whole = {(r["doc_id"], r["collapsed"]): r["runs"] for r in periodic_runs.find_runs(docs).collect()}
    assert whole[(None, "one")] == [] and whole[(0, "")] == []
    [(_, runs)] = [(k, v) for k, v in whole.items() if k[0] == 7]
    assert [tuple(r) for r in runs] == [(0, 4000, 1)]
    [(collapsed, runs)] = [(k[1], v) for k, v in whole.items() if k[0] == 4]
    assert [tuple(r) for r in runs] == [(0, 30_000, 977)] and collapsed == " ".join(f"w{i}" for i in range(977))
    monkeypatch.setattr(periodic_runs, "BLOCK_WORDS", 1)
    assert {(r["doc_id"], r["collapsed"]): r["runs"] for r in periodic_runs.find_runs(docs).collect()} == whole
    assert periodic_runs.find_runs(docs).count() == docs.count()
    assert periodic_runs.find_runs(no_docs).count() == 0


def test_planted_repeats_follow_the_contract():
    changed = 0
    for doc in range(200):
        words = [b"%d" % i for i in range(37)]
        h = zlib.crc32(str(doc).encode())
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        expected = words if h % 10 else [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        changed += expected != words
        assert queries.repeats_put_in(doc, words) == expected
    assert changed and queries.repeats_put_in(10, []) == [] and queries.repeats_put_in(None, [b"a"]) == [b"a"]


def test_digests_of_a_document_without_runs(spark):
    row = QUERIES["op13_periodic_runs"](spark, SF).where("n_runs = 0").first()
    assert row["runs_sha256"] == hashlib.sha256(b"").hexdigest()
    assert [row[c] for c in ("start", "length", "period", "exponent_milli")] == [None] * 4


# --- toxicity: running sums against one unit at a time ------------------------------


def plain_kernel(x, y):
    """The gapped kernel by its definition: every four places of either string."""

    def places(s):
        return [p for p in itertools.combinations(range(len(s)), 4) if p[-1] - p[0] < toxicity.SPAN]

    def weight(p):
        return toxicity.DECAY ** (p[-1] - p[0] + 1)

    size = [math.sqrt(sum(weight(p) ** 2 for p in places(s))) for s in (x, y)]
    found = sum(
        weight(p) * weight(q) for p in places(x) for q in places(y) if [x[i] for i in p] == [y[i] for i in q]
    )
    return found / size[0] / size[1] if all(size) else 0.0


def test_kernel_equals_its_definition():
    strings = ["idiot", "id-iot", "i.d.i.o.t", "abcd", "dcba", "aaaaaaa", "moron", "abc", "idiots are"]
    found = toxicity.kernel(strings, strings)
    for i, x in enumerate(strings):
        for j, y in enumerate(strings):
            # Marks are told apart by classes of their own, so these few do not collide.
            assert math.isclose(found[i, j], plain_kernel(x, y), rel_tol=1e-6, abs_tol=1e-9)


def test_training_holds_no_table_of_strings_by_subsequences(monkeypatch):
    rng = np.random.default_rng(5)
    strings = ["".join(rng.choice(list("abcdefghijklmnop"), 12)) for _ in range(1_200)]
    marks = strings[:300]
    tracemalloc.start()
    try:
        found = toxicity.kernel(strings, marks)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6  # over 200 MB with the table
    monkeypatch.setattr(toxicity, "STRINGS", 7)
    monkeypatch.setattr(toxicity, "PAIRS", 50)
    assert np.allclose(toxicity.kernel(strings[:40], marks), found[:40])
    assert np.allclose(found[:300], found[:300].T)


def test_machine_is_the_same_in_blocks(monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 5))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=90) > 0, 1.0, -1.0)
    whole = toxicity._svm(x, y, np.ones(90))
    monkeypatch.setattr(toxicity, "FEATURE_ROWS", 11)
    parts = toxicity._svm(x, y, np.ones(90))
    assert np.allclose(whole[0], parts[0]) and math.isclose(whole[1], parts[1], abs_tol=1e-9)


def test_running_sums_equal_one_unit_at_a_time(monkeypatch):
    random.seed(4)
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 1 << 24, 3_000_000)).astype(np.int32)
    model = toxicity.Model(codes, rng.normal(size=len(codes)).astype(np.float32), -0.2)
    texts = ["", None, "!!", "a b c d e", "id iot", "I. d, i. o; t", "-- a --", "x !! y", "a-" * 40, "ab cd ef gh ij kl mn op qr", "x\x1cy"]
    texts += ["".join(random.choices("aBc.-_! é日\n1", k=random.randrange(70))) for _ in range(600)]
    plain = [max(model.margins(sorted(toxicity.units(t))), default=model.bias) for t in texts]
    assert np.allclose(list(model.worst(texts)), plain, atol=1e-6)
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 50)
    assert np.allclose(list(model.worst(texts)), plain, atol=1e-6)


def test_toxicity_beside_columns_of_the_same_names(spark):
    rows = [(1, "you idiot", 0.25, 7, "m", "x"), (1, "you idiot", 0.25, 7, "m", "x"), (2, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double, predicted int, margin string, `a b` string")
    row, code, value = toxicity.subsequences(["idiot"])
    codes, place = np.unique(code, return_inverse=True)
    model = toxicity.Model(codes, 9 * np.bincount(place, value), -1.0)
    assert sorted(r["predicted"] for r in toxicity.score(docs, model).collect()) == [0, 1, 1]
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [rows[2]]
