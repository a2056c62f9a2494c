"""Operators 11 to 13 against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from roadlens.llm import collocations, divergence, lattice

DOC = "doc_id long, text string, lang string, source string, n_chars long, term string, `index` int"
ODD = [None, "", " \n\t ", "one", "É é ſ K 日本 語 日本 語", "\x00a\x0bb odd \x1c space\x85here\x00", "▁ ▁x x▁", "a.b,c;d a a.b",
       "lorem ipsum dolor " * 5000, "x" * 20_000]


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def corpus(spark, n=160, seed=3):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "delta", "and", "of", "the", "é", "x1", "w-w", "New", "York", "City"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n"]) for _ in range(rng.randrange(60)))
        if i % 3 == 0:
            text += " New York City and of the. "
        rows.append((i, text, rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "c", None, "ä"])))
    rows += [(1000 + i, t, "en", "odd") for i, t in enumerate(ODD)]
    rows += [(7, rows[7][1], "en", "a")] * 2 + [(None, "the end", None, "a"), (2000, "alone", "fr", "a"), (2001, "", "fr", "b")]
    return rows, spark.createDataFrame([(*r, 0, "extra", 1) for r in rows], DOC)


def brute_divergence(rows, min_df):
    docs = [(re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t)), g or "", s or "") for _, t, g, s in rows]
    out = set()
    for lang in {g for _, g, _ in docs}:
        mine = [(Counter(w), s) for w, g, s in docs if g == lang]
        df = Counter(t for w, _ in mine for t in w)
        kept = sorted(t for t in df if df[t] >= min_df)
        v = len(kept)
        count = {s: Counter() for _, s in mine}
        for w, s in mine:
            count[s].update({t: k for t, k in w.items() if df[t] >= min_df})
        whole = sum(count.values(), Counter())

        def p(c):
            return {t: 1 + 10**9 * (c[t] + 2) // (c.total() + 2 * v) for t in kept}

        q = p(whole)
        ps = {s: p(c) for s, c in count.items()}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in count:
            pair = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in count if o != s]
            term = [(-f(ps[s][t], q[t]), t) for t in kept if count[s][t] and ps[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, 10)):
                out |= {(lang, s, part, i, -x, r) for r, (x, i) in
                        enumerate(sorted(items, key=lambda y: (y[0], y[1].encode()))[:most], 1)}
    return out


@pytest.mark.parametrize("how", [{}, {"shard_terms": 4, "block_entries": 7, "stripe_sources": 2, "batch_terms": 40}])
def test_divergence_is_exact_in_any_number_of_shards_blocks_and_stripes(spark, how, monkeypatch):
    rows, docs = corpus(spark)
    if how:
        monkeypatch.setattr(divergence, "SAMPLE", 1)
    got = divergence.audit(docs, **how).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got} == brute_divergence(rows, 10)


def test_divergence_of_nothing(spark):
    _, docs = corpus(spark, 5)
    assert divergence.audit(docs.limit(0)).count() == 0
    few = divergence.audit(docs.filter("lang = 'fr'")).collect()
    assert {(r.source, r.item, r.value, r["rank"]) for r in few} == {("a", "b", 0, 1), ("b", "a", 0, 1)}


def test_divergence_takes_counts_beyond_64_bits(spark):
    big = 10**13
    row = spark.range(1).selectExpr(f"{big}L AS c", f"{3 * big}L AS n", "10L AS v").withColumn(
        "p", divergence.scaled("c", "n", "v")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (3 * big + 20)


def brute_phrases(rows, min_count=10, top=2000):
    grams = {}
    for _, t, g, _ in rows:
        f = grams.setdefault("und" if g is None else g, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(t)):
            w = re.findall("[^\x20\x09]+", piece)
            f.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in grams.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        best = []
        for p, a in cand.items():
            if any(len(o) > len(p) and 100 * b >= 50 * a and any(o[i:i + len(p)] == p for i in range(len(o)))
                   for o, b in cand.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


@pytest.mark.parametrize("shard_words", [50, collocations.SHARD_WORDS])
def test_collocations_are_exact_across_shards(spark, shard_words):
    rows, docs = corpus(spark)
    got = {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score)
           for r in collocations.collocations(docs, shard_words=shard_words).collect()}
    assert got == brute_phrases(rows)
    assert any(len(g[2].split()) == 3 for g in got) and any(g[0] == "und" for g in got)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_full_bit_sets_lose_nothing(spark, monkeypatch):
    rows, docs = corpus(spark, 60)
    monkeypatch.setattr(collocations, "bit_set", lambda parts, hashed: np.full(1 << 12, 255, np.uint8))
    got = {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(docs).collect()}
    assert got == brute_phrases(rows)


@pytest.mark.parametrize("sigma", [4, collocations.PACKED_SYMBOLS])
def test_fm_index_intervals_match_occurrences(sigma):
    rng = np.random.default_rng(5)
    text = np.concatenate([[0], rng.integers(0, 5, 400)])
    index, every = collocations.ShardIndex(text, sigma), np.ones(sigma + 1, bool)
    two = index.extend(index.words(every), "left", every)
    sides = [index.extend(two, side, every) for side in ("left", "right")]
    for at, k in ((two, 2), (sides[0], 3), (sides[1], 3)):
        want = Counter(tuple(text[i:i + k]) for i in range(len(text) - k + 1) if 0 not in text[i:i + k])
        assert {tuple(p): n for p, n in zip(at["phrase"].tolist(), at["n"].tolist())} == want


def segmentations(word, pieces):
    """Every way to cut ``word`` into pieces."""
    if not word:
        yield []
    for j in range(1, len(word) + 1):
        if word[:j] in pieces:
            for rest in segmentations(word[j:], pieces):
                yield [word[:j], *rest]


def test_lattice_sums_all_segmentations():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba", b"bb", b"abbab"]
    logs = np.log(np.array([5, 4, 3, 2, 2, 1, 1, 1]) / 19)
    model, by = lattice.Lattice(pieces, logs), dict(zip(pieces, logs))
    for n in range(1, 8):
        for word in map(bytes, itertools.product(b"ab", repeat=n)):
            ways = list(segmentations(word, set(pieces)))
            weight = [math.exp(sum(by[p] for p in way)) for way in ways]
            assert math.isclose(model.forward(word), math.log(sum(weight)), rel_tol=1e-12)
            want = Counter()
            for way, x in zip(ways, weight):
                for p in way:
                    want[p] += 3 * x / sum(weight)
            got = Counter()
            model.expected(word, 3, got)
            assert set(got) == set(want) and all(math.isclose(got[p], want[p]) for p in want)


def test_word_probabilities_of_a_length_add_up():
    """Over the whole byte alphabet, all one-byte texts and pieces of the
    vocabulary: a proper distribution never gives more than one."""
    pieces, logs = lattice.initial_scores(lattice.vocabulary_path())
    assert math.isclose(np.exp(logs).sum(), 1, rel_tol=1e-9)
    model = lattice.Lattice(pieces, logs)
    assert sum(math.exp(model.forward(bytes([b]))) for b in range(256)) < 1
    assert all(math.isfinite(model.forward(w)) for w in (b"\xff", "日本".encode(), b"a" * 5000))


@pytest.mark.parametrize("frequent", [0, 5, lattice.FREQUENT])
def test_likelihoods_in_any_split_of_the_words(spark, frequent):
    rows, docs = corpus(spark)
    got = lattice.score_texts(docs, frequent=frequent).collect()
    tokens = [re.findall("[^\x20\x09-\x0d]+", low(t)) for _, t, _, _ in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, *_ in rows]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in [*ws, None])
    n, v = c.total(), len(c)
    assert any(held) and len(got) == len(rows)
    words = spark.createDataFrame([(w, k) for w, k in c.items() if w], "word string, c long")
    pieces, logs = lattice.learn(words, c[None], lattice.vocabulary_path())
    model = lattice.Lattice(pieces, logs)
    want = Counter()
    for (i, *_), ws, h in zip(rows, tokens, held):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*ws, None])
        score = (logs[-1] + sum(model.forward(b" " + w.encode()) for w in ws)) / math.log(10)
        want[i, h, len(ws) + 1, sum(w in c for w in [*ws, None]), n, round(base, 5), round(score, 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5),
                    round(r.score, 5)) for r in got) == want


def test_learned_pieces_fit_held_out_text_better_than_the_given_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned, given = (
        lattice.score_texts(docs, rounds=r).filter("held_out").selectExpr("sum(score) s").first().s for r in (2, 0))
    assert learned > 0.95 * given  # log10: nearer to 0 is better
    assert learned < 0


def test_likelihoods_without_training_documents_or_rows(spark):
    docs = spark.createDataFrame([(i, "some text", "en", "a", 0, "", 1) for i in range(50)
                                  if zlib.crc32(str(i).encode()) % 7 == 2], DOC)
    for r in lattice.score_texts(docs).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and r.score < 0
    assert lattice.score_texts(docs.limit(0)).count() == 0


@pytest.mark.parametrize("batch_terms", [4, 1 << 21])
def test_divergence_vectorises_a_term_once_a_group_not_once_an_occurrence(spark, batch_terms):
    rows, docs = corpus(spark)
    docs = docs.coalesce(1)
    got = divergence.tagged(docs, "text", "lang", "source", batch_terms).collect()
    found = [(g or "", s or "", Counter(f"{g or ''}\0{w}" for w in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t))))
             for _, t, g, s in rows]
    own = Counter((r.lang, r.source, frozenset(r.terms)) for r in got if r.times is None)
    assert own == Counter((g, s, frozenset(c)) for g, s, c in found)
    assert all(len(r.terms) == len(set(r.terms)) for r in got if r.times is None)
    sums, seen = Counter(), Counter()
    for r in got:
        for t in r.alike or []:
            sums[r.lang, r.source, t] += r.times
            seen[r.lang, r.source, t] += 1
    want = Counter()
    for g, s, c in found:
        want.update({(g, s, t): k for t, k in c.items()})
    assert sums == want
    if batch_terms > 4:  # all texts at once
        assert max(seen.values()) == 1
