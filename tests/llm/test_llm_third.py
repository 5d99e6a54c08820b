"""Language identification, hard negatives and spelling variants, against
brute force, planted mixtures and held-out accuracy."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid, negatives, queries, variants

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")
CLASH = "lang_pred string, score double, languages int, row long, n long, word string, part int, `__text` string"
CLASHING = ("x", 0.5, 1, 2, 3, "y", 4, "z")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.prepare(spark)


# --------------------------------------------------------------------------- languages
@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.learn(docs, F.col("doc_id") % 4 != 2)


def test_language_query(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op11_language_id"](spark, SF).collect()}
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == known.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 for r in rows.values())
    held = [i for i, r in rows.items() if r.held_out]
    assert sum(rows[i].lang_pred == known[i] for i in held) >= 0.97 * len(held)


def test_languages_of_mixtures(docs, model):
    """Texts put together of two languages' held-out words."""
    rows = docs.where("doc_id % 4 = 2 and n_chars between 400 and 6000").collect()
    by = {lang: [r.text.split() for r in rows if r.lang == lang] for lang in model.languages}
    rnd, judge, right, near = random.Random(5), langid.Judge(model), 0, 0
    for _ in range(100):
        a, b = rnd.sample(model.languages, 2)
        words = rnd.choice(by[a])[:60] + rnd.choice(by[b])[:30]
        found = dict(judge([" ".join(words)])[0])
        right += set(found) == {a, b}
        near += abs(found.get(a, 0) - 2 / 3) < 0.15
    assert right >= 90 and near >= 80, (right, near)


def _reference(model, text):
    """The same model in plain loops: (languages with proportions, largest first)."""
    words = Counter(re.findall(r"[^\W\d_]{1,%d}" % langid.PIECE, text.lower()))
    k = len(model.languages)
    like = {}
    for w in words:
        grams, _ = langid._grams([w])
        logs = [sum(float(model.log_p[g, j]) for g in grams) for j in range(k)]
        like[w] = [math.exp(x - max(logs)) for x in logs]

    def fit(langs, rounds):
        share = {j: 1 / len(langs) for j in langs}
        for _ in range(rounds):
            new = dict.fromkeys(langs, 0.0)
            for w, c in words.items():
                total = sum(share[j] * like[w][j] for j in langs)
                for j in langs:
                    new[j] += c * share[j] * like[w][j] / max(total, 1e-300)
            share = {j: x / sum(words.values()) for j, x in new.items()}
        return share, sum(c * math.log(max(sum(share[j] * like[w][j] for j in langs), 1e-300)) for w, c in words.items())

    share, _ = fit(range(k), langid.FULL_ROUNDS)
    order = sorted(range(k), key=lambda j: (-share[j], j))
    best, chosen = -math.inf, None
    for size in range(1, k + 1):
        got, score = fit(order[:size], langid.SET_ROUNDS if size > 1 else 0)
        score -= langid.PENALTY * (size - 1) * math.log(sum(words.values()) + 1)
        if score <= best:
            break
        best, chosen = score, got
    return sorted(((model.languages[j], s) for j, s in chosen.items()), key=lambda x: (-x[1], x[0]))


def test_mixture_against_plain_loops(docs, model):
    texts = [r.text for r in docs.where("n_chars < 3000").limit(15).collect()]
    texts += [" ".join(a.split()[:40] + b.split()[:25]) for a, b in zip(texts, texts[5:])]
    texts = [t for t in texts if re.search(r"[^\W\d_]", t)]
    for text, found in zip(texts, langid.Judge(model)(texts)):
        want = _reference(model, text)
        assert [x[0] for x in found] == [x[0] for x in want]
        assert np.allclose([x[1] for x in found], [x[1] for x in want], atol=1e-6)


def test_trigrams_of_words_do_not_depend_on_neighbours():
    words = ["a", "über", "日本語", "zz"]
    grams, starts = langid._grams(words)
    alone = [langid._grams([w])[0].tolist() for w in words]
    assert [x.tolist() for x in np.split(grams, starts[1:])] == alone and [len(x) for x in alone] == [1, 4, 3, 2]


def test_language_edge_cases(spark, model):
    texts = [None, "", " \n\t", "123 456 ²³ --", "the and of the and", "ab" * 400_000, "x" * 50, "the and " * 100_000]
    rows = [(i, t, *CLASHING) for i, t in enumerate(texts)] + [(None, "the and of", *CLASHING), (4, texts[4], *CLASHING)]
    out = langid.identify(spark.createDataFrame(rows, f"doc_id long, text string, {CLASH}"), model).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [(by[i].lang_pred, by[i].score) for i in range(4)] == [("und", 0.0)] * 4
    assert by[4].lang_pred == by[7].lang_pred == by[None].lang_pred == "en"
    assert all(r.lang_pred in model.languages and 0 < r.score <= 1 for r in out if r.doc_id is None or r.doc_id > 3)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    none = langid.learn(empty, F.lit(True))
    assert none.languages == () and langid.identify(empty, model).count() == 0
    got = langid.identify(spark.createDataFrame([(1, "word")], "doc_id long, text string"), none).first()
    assert (got.lang_pred, got.score, got.languages) == ("und", 0.0, [])
    part = spark.createDataFrame([("ja nein", None), (None, "de"), ("ja nein", "de")], "text string, lang string")
    assert langid.learn(part, F.lit(True)).languages == ("de",)


def test_long_texts_are_counted_whole(monkeypatch):
    text = " ".join(f"w{chr(97 + i % 26) * (i % 40)}" for i in range(5000))
    whole = langid.Words()
    no, counts = langid._numbers(text, whole)
    monkeypatch.setattr(langid, "SLICE", 1000)
    cut = langid.Words()
    no2, counts2 = langid._numbers(text, cut)
    assert dict(zip((whole.fresh[i] for i in no), counts)) == dict(zip((cut.fresh[i] for i in no2), counts2))


# --------------------------------------------------------------------------- hard negatives
def brute_negatives(rows, step=50, positives=5, wanted=3):
    """(anchor, positive, rank, negative, scores) by all inner products."""
    good = [(i, x, v) for i, v, x in rows if i is not None and x is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    good = [(i, x, [math.floor(256 * c) for c in v]) for i, x, v in good]
    out = []
    for i, x, v in {(i, x, tuple(v)) for i, x, v in good if i % step == 0}:
        score = [(sum(a * b for a, b in zip(v, w)), j, y) for j, y, w in good if j != i and len(w) == len(v)]
        for p, j in sorted(((s, j) for s, j, y in score if y == x), key=lambda t: (-t[0], t[1]))[:positives]:
            fit = sorted(((s, k) for s, k, y in score if y != x and 50 * p <= 100 * s <= 95 * p), key=lambda t: (-t[0], t[1]))[:wanted]
            out += [(i, j, r + 1, k, p, s) for r, (s, k) in enumerate(fit)]
    return Counter(out)


def mined(spark, rows):
    extra = "rank int, v int, extra int, positive_id string"
    frame = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], f"vec_id long, embedding array<float>, label int, {extra}")
    return Counter(tuple(r) for r in negatives.mine(negatives.taking_part(frame), F.col("vec_id") % 50 == 0).collect())


def test_hard_negatives_against_all_products(spark):
    rnd = np.random.default_rng(3)
    group = rnd.normal(size=24)
    rows = []
    for i in range(900):
        v = group + rnd.normal(size=24) * 0.2 if i % 3 == 0 else rnd.normal(size=24)  # a third in one tight group
        rows.append((i, np.float32(v).tolist(), int(rnd.integers(0, 4))))
    rows += [(1000 + i, np.float32(group).tolist(), i % 2) for i in range(200)]  # equal vectors
    assert mined(spark, rows) == brute_negatives([(i, [float(c) for c in v], x) for i, v, x in rows])


def test_hard_negatives_of_odd_rows(spark):
    near = [[0.5, 0.25, 1.0], [0.4, 0.3, 0.9], [0.45, 0.2, 1.0], [0.5, 0.25, 0.5]]
    rows = [(50, near[0], 1), (50, near[0], 1), (50, near[1], 2), (1, near[1], 1), (1, near[1], 1), (2, near[2], 2), (3, near[3], 2), (3, near[3], 2)]
    rows += [(4, None, 1), (5, [1.0, None, 1.0], 1), (6, [float("nan"), 1.0, 1.0], 1), (7, [float("inf"), 1.0, 1.0], 2), (8, near[0], None), (None, near[0], 1)]
    rows += [(9, [0.0, 0.0, 0.0], 1), (10, [0.0, 0.0, 0.0], 2), (100, [0.0, 0.0, 0.0], 1), (11, [1.0], 1), (150, [1.0], 1), (12, [0.9], 2), (13, [], 1), (14, [], 2), (200, [], 1)]
    rows += [(15, [1000.0, -2000.0, 3.0], 1), (16, [-1.0, -1.0, -1.0], 2)]
    got = mined(spark, rows)
    assert got == brute_negatives(rows) and len(got) > 20
    huge = [(17, [3e38, 1.0, 1.0], 2), (18, [3e38, 1.0, 1.0], 1)]  # scores that no long holds: no part
    assert mined(spark, rows + huge) == got
    assert mined(spark, []) == Counter() and mined(spark, rows[3:5]) == Counter()


@pytest.mark.parametrize("dim", [1, 24, 64, 130])
def test_intervals_hold_the_scores(dim):
    rnd = np.random.default_rng(dim)
    rows = np.floor(256 * rnd.normal(size=(300, dim)) * rnd.choice([0, 0.01, 1, 50], size=(300, 1))).astype(np.int64)
    asked = np.floor(256 * rnd.normal(size=(40, dim))).astype(np.int64)
    low, high = negatives.Anchors(asked).bounds(slice(0, 40), *negatives.encode(rows))
    exact = asked @ rows.T
    assert (low <= exact).all() and (exact <= high).all()
    lengths = np.linalg.norm(asked, axis=1)[:, None] * np.linalg.norm(rows, axis=1)
    assert np.median(((high - low) / (lengths + 1))) < 0.5  # of a range of 2: the intervals tell something


# --------------------------------------------------------------------------- variants
def brute_pairs(words):
    there, letters, out = set(words), sorted(set("".join(words))), set()
    for w in words:
        for i in range(len(w) + 1):
            near = [w[:i] + c + w[i:] for c in letters] + ([w[:i] + w[i + 1 :]] + [w[:i] + c + w[i + 1 :] for c in letters] if i < len(w) else [])
            out |= {(w, x) for x in near if x in there and x != w}
    return out


def brute_variants(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {}
    for w, x in brute_pairs(list(words)):
        near.setdefault(w, []).append(x)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x))
        if words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near.get(w, [])), words[form[w]] if w in form else None) for w, n in words.items()}


def grouped(spark, rows):
    frame = spark.createDataFrame([(*r, *CLASHING) for r in rows], f"doc_id long, text string, {CLASH}").repartition(7)
    out = variants.group_variants(variants.count_words(frame, variants.drop_letter))
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in out.collect()}


def misspelt(rnd, vocabulary, size):
    words = []
    for _ in range(size):
        w = rnd.choice(vocabulary)
        for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
            k, c = rnd.randrange(len(w) + 1), rnd.choice("abcé")
            w = rnd.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]])
        words.append(w)
    return words


@pytest.mark.parametrize("shard", [variants.SHARD, 40])
def test_variants_against_brute_force(spark, monkeypatch, shard):
    """With small shards halves are split over several, too."""
    monkeypatch.setattr(variants, "SHARD", shard)
    rnd = random.Random(shard)
    vocabulary = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(5, 11))) for _ in range(25)] + ["prefix" + x for x in ("aaaaa", "abcab", "ccccc")]
    rows = [(i, " ".join(misspelt(rnd, vocabulary, 80))) for i in range(400)]
    want = brute_variants(rows)
    assert grouped(spark, rows) == want and sum(x[1] is not None for x in want) > 100 and any(x[1] and x[1] != x[2] for x in want)


def test_variants_of_the_documents(spark):
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in queries.QUERIES["op13_spelling_variants"](spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got == brute_variants(rows)


def test_variants_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(variants, "SLICE", 100)
    rows = [(1, None), (2, ""), (None, "Grüße Grüße grüße gr×üße"), (3, " \n12 "), (4, "a" * 3000 + " " + "a" * 2999), (4, "a" * 3000 + " " + "a" * 2999)]
    rows += [(5, ("a" * 3000 + " " + "a" * 2999 + "b ") * 3), (6, "GRÜSSE grÜsse Grüsse ÀÖØöø÷ÿ " * 3), (7, "kitten kittens sitten 日本語kitten " * 30)]
    got = grouped(spark, rows)
    assert got == brute_variants(rows) and len(got) >= 8
    assert grouped(spark, []) == set() and grouped(spark, [(1, None)]) == set()


def test_suffix_intervals(monkeypatch):
    """Longer words than the first comparison of suffixes takes in."""
    rnd = random.Random(1)
    words = list({"".join(rnd.choice("ab") for _ in range(rnd.randint(5, 9))) for _ in range(200)} | {"ab" * 60, "ab" * 59 + "a", "a" * 90, "a" * 89 + "b"})
    n = len(words)
    shard = pa.table({"left": [False] * n + [True] * n, "word": words * 2, "n": [1] * 2 * n, "asks": [True] * 2 * n, "target": [True] * 2 * n})
    found = variants._near(shard)
    assert set(zip(found["word"].to_pylist(), found["near"].to_pylist())) == brute_pairs(words)


# --------------------------------------------------------------------------- earlier operators
def test_long_white_space_is_packed_and_counted(spark):
    """Runs of a million white-space characters, and special strings beside them."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from tessera.llm import packing, tokens

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["\n" * 1_000_000 + "x", " " * 1_000_000 + "x", "a b" + " \n\t" * 20_000 + "c <|endoftext|> d", "x" + "　" * 50_000, "ok " * 4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: [*tok.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    got = {}
    for r in sorted(packing.pack(docs).collect(), key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == want
    assert {r.doc_id: r.n_tokens + 1 for r in tokens.count_tokens(docs).collect()} == {i: len(x) for i, x in want.items()}


def test_near_duplicates_of_an_id_on_several_texts(spark):
    """Every text of a repeated id is searched, not one of them."""
    from tessera.llm import minhash

    rnd = random.Random(2)
    x, y, z = ([f"w{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(3))
    near = lambda w, k: [*w[:k], "other", *w[k + 1 :]]
    rows = [(1, x), (1, y), (5, near(y, 1)), (7, near(x, 58)), (7, z), (9, near(z, 0)), (3, near(z, 59)), (8, y)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == sorted([(1, 1, True), (1, 1, True), (5, 1, False), (7, 1, False), (8, 1, False), (3, 3, True), (7, 3, False), (9, 3, False)])
    assert sorted(r.doc_id for r in minhash.deduplicated(docs).collect()) == [1, 1, 3]


def test_pieces_of_long_texts_hold_every_window_once():
    from tessera.llm import suffix

    rnd = random.Random(1)
    texts = [bytes(rnd.choices(b"abc", k=n)) for n in (0, 5, 199, 200, 700, 4321, 1000)]
    for limit in (200, 256, 1000, 10**6):
        windows = Counter()
        for pieces in suffix._pieces(texts, 200, limit):
            assert sum(len(p[2]) for p in pieces) <= 2 * limit + 400
            for i, at, data in pieces:
                assert texts[i][at : at + len(data)] == data
                windows.update((i, at + k) for k in range(len(data) - 199))
        assert windows == Counter((i, k) for i, t in enumerate(texts) for k in range(len(t) - 199))


def test_repeats_within_and_across_long_texts(spark):
    """A text of 20 MB and shorter ones; repeats at piece borders, and over them."""
    import xxhash

    from tessera.llm import suffix

    rnd = np.random.default_rng(4)
    letters = lambda n: rnd.integers(97, 123, n).astype(np.uint8).tobytes()
    step, shared = suffix.CHUNK_BYTES, letters(900)
    long = bytearray(letters(20_000_000))
    for at in (step - 450, 3 * step - 1, 5 * step - 199, 7 * step + 5, 20_000_000 - 900):
        long[at : at + 900] = shared
    other = bytearray(letters(700_000))
    other[300_000:300_250] = long[9 * step - 100 : 9 * step + 150]
    rows = [bytes(long), bytes(other), letters(500) + shared[100:400], b"z" * 600_000]
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r.row.doc_id: (r.n_removed, [(s.start, s.stop) for s in r.spans], xxhash.xxh64_hexdigest(r.kept)) for r in suffix.remove_repeats(docs).collect()}
    spans = {
        0: [*((at, at + 900) for at in (step - 450, 3 * step - 1, 5 * step - 199, 7 * step + 5)), (9 * step - 100, 9 * step + 150), (20_000_000 - 900, 20_000_000)],
        1: [(300_000, 300_250)],
        2: [(500, 800)],
        3: [(0, 600_000)],
    }
    for i, text in enumerate(rows):
        kept, at = b"", 0
        for a, b in spans[i]:
            kept, at = kept + text[at:a], b
        assert got[i] == (sum(b - a for a, b in spans[i]), spans[i], xxhash.xxh64_hexdigest(kept + text[at:]))


def test_members_that_ask_meet_all_others(spark):
    """Every member outside its group's largest component meets every member of
    the group, in bounded blocks; the largest component does not meet itself."""
    from tessera.llm import minhash

    rnd = random.Random(5)
    member = [("big", i, 0 if i < 150 else rnd.randrange(1, 9)) for i in range(200)] + [("one", i, 7) for i in range(300, 340)]
    member += [("two", i, i) for i in range(400, 402)]
    rows = spark.createDataFrame(member, "cluster string, rep long, component long")
    apart = minhash._apart(rows, "cluster", F.lit(1), 20)
    assert sorted(tuple(r) for r in apart.collect()) == [("big", 0, 3, 10), ("two", 401, 1, 1)]
    dealt = minhash._in_blocks(minhash._dealt(rows, apart, "cluster", F.lit(4), F.lit(4)), "cluster")
    blocks = {}
    for r in dealt.collect():
        blocks.setdefault((r.key, r.lo, r.hi), []).append(r)
    assert len(blocks) == 31 and max(len(b) for b in blocks.values()) < 80
    assert all(len({r.rep for r in b}) == len(b) for b in blocks.values())
    met = Counter((r.rep, o.rep) for b in blocks.values() for r in b if r.asks for o in b)
    for group, size in (("big", 200), ("two", 2)):
        ids = [i for g, i, _ in member if g == group]
        asking = [i for g, i, c in member if g == group and c != {"big": 0, "two": 401}[group]]
        assert {r for r, _ in met} & set(ids) == set(asking)
        assert all((a, b) in met for a in asking for b in ids)


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    """A bucket and a cluster larger than a block give the components of brute force."""
    from tessera.llm import minhash

    monkeypatch.setattr(minhash, "BUCKET_ROWS", 5)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(60)]
    texts = {}
    for i in range(60):  # copies with edits at random places: linked with some of the others, not with all
        words = list(base)
        for _ in range(rnd.randrange(0, 4)):
            words[rnd.randrange(60)] = f"x{rnd.randrange(10**6)}"
        texts[i] = " ".join(words)
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, t in texts.items() for w in [t.split()]}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: find(i) for i in sets}


# --------------------------------------------------------------------------- mixing
def test_mix_deals_repeated_rows_over_buckets(spark, monkeypatch):
    """A row that makes up a third of the table fills many buckets; every row has
    a place of its own, and its words are taken as often as its source's passes say."""
    from tessera.llm import mixing

    monkeypatch.setattr(mixing, "_BUCKET_ROWS", 16)
    rows = [(7, "one two three", "a")] * 200 + [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(100, 500)] + [(None, None, None)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing.sizes(docs)
    placed = mixing.place(sized, sized.count()).collect()
    assert len(placed) == len(rows)
    for key in "sa", "sb", "n":
        line = sorted((r.start, r.start + r["size"]) for r in placed if r.skey == key and r["size"])
        assert all(x[1] == y[0] for x, y in zip(line, line[1:])) and (not line or line[0][0] == 0)
    per = Counter((r.skey, r.bucket) for r in placed if r.doc_id == 7)
    assert len(per) > 8 and max(per.values()) <= 48
    got = mixing.taken_words(docs).collect()
    assert sorted(((r.doc_id or 0, r["size"]) for r in got)) == sorted(((i or 0, len((t or "").split())) for i, t, _ in rows))
    for r in got:
        passes = int(r.target // r.source_size) if r.source_size else 0
        assert passes * r["size"] <= r.taken <= (passes + 1) * r["size"]
    for size in {r.source_size for r in got}:
        own = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1


# --------------------------------------------------------------------------- class model
def test_class_model_against_plain_loops(spark):
    """Scores from the definition: class transitions counted over the training
    texts, words within classes, unknown words by what the classes leave."""
    from tessera.llm import lm

    rnd = random.Random(8)
    nouns, verbs = [f"n{i}" for i in range(12)], [f"v{i}" for i in range(8)]
    pick = lambda: [w for _ in range(rnd.randrange(0, 12)) for w in (rnd.choice(nouns), rnd.choice(verbs))]
    texts = {i: " ".join(pick() + (["odd%d" % i, "Never%d" % i] if i % 5 == 0 else [])) for i in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    held = F.col("doc_id") % 3 == 0
    train = docs.where(~held).select(F.to_binary("text", F.lit("utf-8")).alias("text"))
    vocab = {bytes(r.word).decode(): (r.n, r.cls) for r in lm.cluster(train, classes=4, core=15).collect()}
    words = {i: t.lower().split() for i, t in texts.items()}
    learned = [w for i, w in words.items() if i % 3]
    count = Counter(w for own in learned for w in own)
    assert {w: n for w, (n, _) in vocab.items()} == dict(count)
    size, types, step = Counter({0: len(learned)}), Counter(), Counter()
    for w, (n, c) in vocab.items():
        size[c] += n
        types[c] += 1
    for own in learned:
        line = [0, *(vocab[w][1] for w in own), 0]
        step.update(zip(line, line[1:]))
    total = sum(size.values())
    leaves = {c: sum(n for (a, _), n in step.items() if a == c) for c in size}

    def chance(a, b):  # of class b after class a; None: the word before is unknown
        prior = size[b] / total
        return prior if a is None else (step[a, b] + lm.BACKOFF * prior) / (leaves[a] + lm.BACKOFF)

    def score(own):
        out, before = 0.0, 0
        for w in own:
            if w in vocab:
                n, c = vocab[w]
                out += math.log10(chance(before, c) * (n - lm.DISCOUNT) / size[c])
                before = c
            else:
                out += math.log10(sum(chance(before, c) * lm.DISCOUNT * types[c] / size[c] for c in types))
                before = None
        return out + math.log10(chance(before, 0))

    for table in 5, 1_000:  # words beyond the broadcast table go by the join
        got = {r.doc_id: r.score for r in lm.score(docs, held, classes=4, core=15, table=table).collect()}
        assert got == {i: pytest.approx(score(w), rel=1e-6, abs=1e-6) for i, w in words.items()}


def test_exchange_ends_where_no_move_helps():
    """No single word's move to another class raises the likelihood of the class bigrams."""
    from tessera.llm import lm

    rng = np.random.default_rng(9)
    grid = rng.poisson(2.0, (11, 11)).astype(float)
    cls = lm.exchange(grid, 3, sweeps=100)

    def likelihood(c):
        m = np.zeros((11, 4))
        m[np.arange(11), c] = 1
        g = m.T @ grid @ m
        x = lambda v: float(sum(a * math.log(a) for a in v if a > 0))
        return x(g.ravel()) - x(g.sum(0)) - x(g.sum(1))

    best = likelihood(cls)
    for w in range(10):
        for c in 1, 2, 3:
            other = cls.copy()
            other[w] = c
            assert likelihood(other) <= best + 1e-6


# --------------------------------------------------------------------------- neighbours
def test_recall_above_the_fitted_sample(spark):
    """Production parameters on more vectors than the trees are fitted on, a third
    of them in one tight group."""
    from tessera.llm import ann

    rng = np.random.default_rng(4)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:6_600] = x[0] + 0.05 * x[:6_600]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(rows, F.col("vec_id") % 400 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = {}
    for q in range(0, 20_000, 400):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits[q] = len(found[q] & set(np.argsort(d)[:10].tolist())) / 10
    inside, outside = ([h for q, h in hits.items() if (q < 6_600) == side] for side in (True, False))
    print("recall inside", np.mean(inside), "outside", np.mean(outside), "lowest", min(hits.values()))
    assert np.mean(inside) >= 0.9 and np.mean(outside) >= 0.9
