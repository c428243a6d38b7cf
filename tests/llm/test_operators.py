"""Every operator against a plain version, on odd rows: nulls, empty and long texts, ties, extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from newslens.llm import (
    bloom_cascade, bpe_speculate, brown_lm, column_bwt, exact_dedup, license_scan, mix_flow, pii_votes,
    quality_risk, simhash_cover,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, fp long, _no int"
WORD = r"[^\x20\x09-\x0D]+"


def make(spark, rows):
    """Rows (doc_id, text, lang, source) with extra columns whose names operators use inside."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 7, 1) for r in rows], SCHEMA)


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghiklmnoprstuw", k=r.randint(2, 9))) for _ in range(n))


def corpus():
    base = [prose(i, 120) for i in range(12)]
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}") for i, t in enumerate(base)]
    rows += [(100 + i, base[0], "en", f"s{i % 3}") for i in range(6)]                  # a group of copies
    rows += [(120 + i, base[1].replace(" ", "  \n", i + 1), "en", "s1") for i in range(3)]
    rows += [(140 + i, prose(50 + i, 20) + " " + base[2][:520] + " " + prose(70 + i, 30), "fr", None) for i in range(3)]
    rows += [(160, base[3].replace("a", "e", 1), "en", "s2"), (161, None, None, None), (162, "", "en", "s0"),
             (163, " \t\n ", "en", "s0"), (164, "one", "en", "s0"), (165, "é ß 語 Ünïcode Ω", "xx", "é"),
             (166, "long " * 3000, "en", "s0"), (167, "x" * 4000, "en", "s0"), (None, base[4], None, "s1"),
             (None, None, "en", None), (5, base[5], "en", "s1"), (5, base[5], "en", "s1"),
             (168, "aé" * 500, "en", "s0"), (169, "\ue000 a@b.co \ue000", "en", "s0")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return make(spark, corpus()).cache()


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, [])


def key(row):
    return tuple((x is None, x) for x in row)


def same(df, expected):
    got = sorted((tuple(r) for r in df.collect()), key=key)
    assert got == sorted(expected, key=key)


# 1
def test_license_base_places(docs):
    text = "MIT License, the mit  license; Apache-License CC BY-NC gnu general public license"
    n, places, _ = license_scan.scan(text.encode(), tuple(license_scan.NOTICES))
    assert n == 14 and places == [(0, "mit"), (3, "mit"), (5, "apache"), (7, "cc-by"), (10, "gpl")]
    out = {r["doc_id"]: r for r in license_scan.summary(license_scan.find_licenses(docs)).collect()}
    assert out[161]["n_words"] == 0 and out[161]["first_word"] is None and out[161]["labels"] == ""
    assert out[165]["n_words"] == 5


def test_license_fuzzy_notice_within_its_edits():
    wanted = ("isc-notice", 2, 14, 3)
    text = "so then permision to use copy modify andor distribute this software for any purposes ok"
    _, base, found = license_scan.scan(text.encode(), tuple(license_scan.NOTICES))
    assert base == [] and found and found[0][0] == wanted[0] and found[0][1] == 2 and 0 < found[0][3] <= 5
    _, _, found = license_scan.scan(b"permission to eat cake and drink tea for any reason at all", tuple(license_scan.NOTICES))
    assert found == []


def test_license_places_and_score_equal_a_plain_walk(spark):
    r = random.Random(17)
    words = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "é", "x1", "MIT", "Cc"]
    rows = [(i, r.choice(["", " "]).join(r.choice(words) + r.choice([" ", ", ", "-", "\n"]) for _ in range(40)), "en", "s")
            for i in range(60)]
    full = " ".join(license_scan.NOTICES[0][1].split())
    rows += [(100, full.replace("licensed", "licenced"), "en", "s"), (101, "nothing here", "en", "s")]
    got = {x["doc_id"]: x for x in license_scan.summary(license_scan.find_licenses(make(spark, rows))).collect()}
    for i, text, *_ in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        tokens = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = sorted((k, label) for phrase, label in license_scan.PHRASES.items() for k in range(len(tokens))
                        if tokens[k:k + len(phrase.split())] == phrase.split())
        x = got[i]
        assert (x["n_words"], x["n_base"]) == (len(tokens), len(places))
        assert x["first_word"] == (places[0][0] if places else None) and x["last_word"] == (places[-1][0] if places else None)
        assert x["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(x["base_labels"].split(",")) <= set(x["labels"].split(","))
    # the notice holds a base phrase, so only its label is the method's
    assert got[100]["labels"] == "gpl,gpl-notice" and got[101]["score"] == 0
    one = "permission is hereby granted free of charge to any persn obtaining a copy"
    x = license_scan.summary(license_scan.find_licenses(make(spark, [(1, one, "en", "s")]))).first()
    assert x["labels"] == "mit-notice" and x["score"] == pytest.approx(1 - 1 / (len(one) + 1))


def test_license_seeds_miss_no_match():
    import regex
    label, notice, edits = license_scan.NOTICES[3]
    r = random.Random(3)
    for _ in range(200):
        t = list(notice)
        for _ in range(r.randint(0, edits)):
            t[r.randrange(len(t))] = r.choice(["", "z", "zq"])
        line = " ".join("".join(t).split())
        plain = regex.search(f"(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}", f" {line} ")
        found = [x for x in license_scan.scan(line.encode(), tuple(license_scan.NOTICES))[2] if x[0] == label]
        assert bool(plain) == bool(found)


# 2
def test_brown_scores(docs):
    rows = corpus()
    counts, split = Counter(), []
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split() + [b""]
        held = zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
        split.append((i, held, w))
        if not held:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    base = lambda w: sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
    want = sorted(((i, h, len(w), sum(counts[x] > 0 for x in w), n, round(base(w), 6)) for i, h, w in split), key=key)
    out = brown_lm.score(docs, rounds=2, n_classes=8).collect()
    assert sorted(((*r[:5], round(r["base_score"], 6)) for r in out), key=key) == want
    assert all(r["score"] < 0 for r in out)


def test_brown_model_is_a_distribution():
    import numpy as np
    r = np.random.default_rng(1)
    tokens, distinct = np.array([90.0, 4, 200, 31]), np.array([3.0, 1, 5, 2])
    counts = r.integers(0, 50, (5, 4)).astype(float)
    chain = brown_lm.factors(counts, tokens, distinct, 1.0)
    # words of a class and its unseen word: counts plus a half each
    mass = (chain * (tokens + 0.5 * (distinct + 1))).sum(axis=1)
    assert np.allclose(mass, 1, atol=1e-6)


def class_pairs(words, classes, k):
    import numpy as np
    g = np.zeros((k, k))
    np.add.at(g, (classes[:, None], classes[None, :]), words)
    return g


def test_gains_equal_recounted_likelihoods():
    import numpy as np
    r = np.random.default_rng(2)
    words, classes = r.integers(0, 30, (12, 12)).astype(float), np.arange(12) % 3
    for w in range(12):
        others = words.copy()
        others[w], others[:, w] = 0, 0
        left, right = np.bincount(classes, words[:, w], 3), np.bincount(classes, words[w], 3)
        left[classes[w]] -= words[w, w]
        right[classes[w]] -= words[w, w]
        gain = brown_lm.gains(left, right, words[w, w], class_pairs(others, classes, 3))
        trials = []
        for c in range(3):
            t = classes.copy()
            t[w] = c
            trials.append(brown_lm.likelihood(class_pairs(words, t, 3)))
        assert np.allclose(gain - gain[0], np.array(trials) - trials[0])


def test_exchange_equals_a_recounting_version():
    """Every sweep raises the likelihood, and each move is the one that a full recount prefers."""
    import numpy as np
    r = np.random.default_rng(7)
    words = r.poisson(r.gamma(0.3, 8, (30, 30))).astype(float)
    classes, pairs, course = brown_lm.exchange(words, 4, 6)
    plain, before = np.arange(30) % 4, None
    for _ in range(6):
        before = plain.copy()
        for w in range(30):
            trials = [brown_lm.likelihood(class_pairs(words, np.where(np.arange(30) == w, c, plain), 4)) for c in range(4)]
            best = int(np.argmax(trials))
            if trials[best] > trials[plain[w]] + 1e-9:
                plain[w] = best
        if (plain == before).all():
            break
    assert list(classes) == list(plain) and np.allclose(pairs, class_pairs(words, classes, 4))
    assert all(b >= a - 1e-6 for a, b in zip(course, course[1:])) and course[-1] > course[0]
    assert course[-1] == pytest.approx(brown_lm.likelihood(pairs))


def test_packed_neighbours_keep_all_places():
    import numpy as np
    codes = np.random.default_rng(3).integers(0, 4, (500, 2)).astype(np.uint8)
    counts = b"\1" + b"".join(np.bincount(codes[:, s], minlength=256).astype("<u4").tobytes() for s in (0, 1))
    got = brown_lm._counted([[b"\0" + codes[:40].tobytes(), counts], [b"\0" + codes[:1].tobytes()]])
    for s in (0, 1):
        assert (got[0, s] == np.bincount(codes[:40, s], minlength=256) + np.bincount(codes[:, s], minlength=256)).all()
        assert got[1, s].sum() == 1


def plain_model(rows, model, k, weight):
    """Scores from counts of its own; only classes are taken over."""
    import numpy as np
    known = {bytes(r["word"]): (r["class"], r["c"]) for r in model.known.collect()}
    texts = [(i, (t or "").encode().lower().split() + [b""]) for i, t, *_ in rows]
    training = [w for i, w in texts if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1]
    counts = Counter(x for w in training for x in w)
    n, v = sum(counts.values()), len(counts)
    assert {w: c for w, (_, c) in known.items()} == dict(counts)
    top = {b"", *sorted((w for w in counts if w and len(w) <= 64), key=lambda w: (-counts[w], w))[:model.core_size - 1]}
    grid = np.zeros((k + 1, k))
    for w in training:
        for a, b in zip([b"", *w], w):
            grid[known[a][0] if a in top else k, known[b][0]] += 1
    mass = np.array([sum(c for of, c in known.values() if of == x) for x in range(k)], float)
    kinds = np.array([sum(of == x for of, _ in known.values()) for x in range(k)], float)
    least = n + 0.5 * (v + 1)

    def one(before, word):
        c = counts[word]
        of = known[word][0] if c else model.suffixes[int.from_bytes(word[-2:], "big") % brown_lm.SUFFIXES]
        h = known[before][0] if before in top else k
        chance = (grid[h, of] + (mass[of] + 1) / (mass.sum() + k)) / (grid[h].sum() + 1)
        return math.log10(weight * chance * (c + 0.5) / (mass[of] + 0.5 * (kinds[of] + 1)) + (1 - weight) * (c + 0.5) / least)

    return [(i, round(sum(one(a, b) for a, b in zip([b"", *w], w)), 6)) for i, w in texts]


@pytest.mark.parametrize("bits, core", [(20, 1024), (20, 12), (6, 12)])
def test_brown_scores_equal_a_plain_model(docs, bits, core):
    """With all words broadcast, and with rare words that come by the join."""
    model = brown_lm.fit(docs.where(~brown_lm.held_out(F.col("doc_id"))).select("text"), 3, 5, 0.9, core, bits)
    got = sorted(((r["doc_id"], round(r["score"], 6)) for r in brown_lm.score_with(docs, model).collect()), key=key)
    want = sorted(plain_model(corpus(), model, 5, 0.9), key=key)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want], abs=1e-4)


def test_brown_odd_inputs(spark, none):
    assert brown_lm.score(none).count() == 0
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    only = make(spark, [(i, "a b", "en", "s") for i in held])  # nothing to learn from
    out = brown_lm.score(only).collect()
    assert [r["n_known"] for r in out] == [0, 0, 0] and all(r["score"] < 0 and r["train_tokens"] == 0 for r in out)


def test_classes_lower_held_out_perplexity(spark):
    """Two kinds of sentences that share no words: classes must tell them apart."""
    r = random.Random(5)
    kinds = [["".join(r.choices(letters, k=4)) for _ in range(150)] for letters in ("abcd", "wxyz")]
    rows = [(i, " ".join(r.choices(kinds[i % 2], k=120)), "en", "s") for i in range(150)]
    scored = brown_lm.score(make(spark, rows), n_classes=8)
    held = [p for p in brown_lm.perplexity(scored).collect() if p["held_out"]][0]
    assert held["perplexity"] < 0.6 * held["base_perplexity"]


def two_kinds(n=150):
    """Sentences of two kinds that share no words."""
    r = random.Random(5)
    kinds = [["".join(r.choices(letters, k=4)) for _ in range(150)] for letters in ("abcd", "wxyz")]
    return [(i, " ".join(r.choices(kinds[i % 2], k=120)), "en", "s") for i in range(n)]


def test_words_beyond_the_core_have_histories(spark):
    """Classes tell the kinds apart also where hardly any word is a core word."""
    scored = brown_lm.score(make(spark, two_kinds()), n_classes=8, core=8)
    held = [p for p in brown_lm.perplexity(scored).collect() if p["held_out"]][0]
    assert held["perplexity"] < 0.6 * held["base_perplexity"]


@pytest.mark.parametrize("core", [1, 5, 1024])
def test_sweeps_count_the_pairs_of_all_words(spark, core):
    import numpy as np
    rows = corpus() + [(300 + i, "often seen here and there " * 700 + "z" * 90 + " end", "en", "s") for i in range(2)]
    model = brown_lm.fit(make(spark, rows).select("text").coalesce(2), 4, 6, 0.9, core)
    classes = {bytes(r["word"]): r["class"] for r in model.known.collect()}
    want = np.zeros((6, 6))
    for _, t, *_ in rows:
        w = [classes[x] for x in (t or "").encode().lower().split() + [b""]]
        np.add.at(want, ([classes[b""], *w[:-1]], w), 1)
    assert (model.pairs == want).all()
    assert model.course[-1] == pytest.approx(brown_lm.likelihood(want)) and model.course[-1] > model.course[0]
    assert all(b >= a - 1e-6 for a, b in zip(model.course, model.course[1:]))


def test_words_move_by_all_places():
    """Words with few places, with many in one block, and core words, which stay; two blocks."""
    import numpy as np
    r = np.random.default_rng(4)
    pairs, own, selfs = r.integers(1, 90, (5, 5)).astype(float), r.integers(0, 5, 30), r.integers(0, 3, 30)
    is_core, around, known, sent = np.arange(30) == 7, np.zeros((30, 2, 256)), [], {}
    for block in (0, 1):
        at, n = r.permutation(30)[:20], r.integers(0, 9, 20)
        n[:2] = 3000
        places = [r.integers(0, 5, (x, 2)).astype(np.uint8) for x in n.tolist()]
        for w, x in zip(at.tolist(), places):
            around[w] += np.stack([np.bincount(x[:, side], minlength=256) for side in (0, 1)])
        send = [(w, x) for w, x in zip(at.tolist(), places) if w != 7]
        many = [np.bincount(x[:, side], minlength=256).astype("<u4") for _, x in send if len(x) > 1024 for side in (0, 1)]
        few = np.concatenate([x for _, x in send if len(x) <= 1024])
        known.append({"block": block, "a": brown_lm._shut(at.astype(np.int32)), "b": brown_lm._shut(n.astype(np.int32))})
        sent[block] = {"a": brown_lm._shut(few.view(np.uint16)), "b": brown_lm._shut(np.concatenate(many))}
    got = brown_lm._moved(own, selfs, is_core, known, sent, pairs)
    want = np.where(is_core, own, brown_lm.classes_of(around, pairs, own, selfs))
    assert list(got) == list(want) and (got != own).any()


def test_sweeps_that_lower_the_likelihood_are_taken_back(spark, monkeypatch):
    import numpy as np
    plain, send, parts = brown_lm.replies, brown_lm.contexts, []

    def spoiled(shares, units, old=None, messages=None, pairs=None):
        # in the first sweep classes go by the wrong pairs
        return plain(shares, units, old, messages, np.roll(pairs, 1, axis=1) if len(parts) == 2 else pairs)

    def watched(blocks, replies, units, core, *part):
        parts.append(part)
        return send(blocks, replies, units, core, *part)

    monkeypatch.setattr(brown_lm, "replies", spoiled)
    monkeypatch.setattr(brown_lm, "contexts", watched)
    model = brown_lm.fit(make(spark, two_kinds(60)).select("text"), 4, 8, 0.9, 8)
    assert parts[1:4] == [(1, 0), (2, 0), (2, 1)]
    assert all(b >= a - 1e-6 for a, b in zip(model.course, model.course[1:]))
    assert model.course[-1] == pytest.approx(brown_lm.likelihood(model.pairs))


def test_odd_arrays_are_opened_as_shut():
    import numpy as np
    for x in (np.empty(0, np.int64), np.array([True, False]), np.arange(-5, 999, dtype=np.int16), np.array([2 ** 62, -1])):
        assert (brown_lm._open(brown_lm._shut(x), x.dtype) == x).all() and len(brown_lm._open(brown_lm._shut(x), x.dtype)) == len(x)


def test_places_keep_their_order():
    import numpy as np
    for top in (1, 5, 70_000, 2 ** 31):
        x = np.random.default_rng(top).integers(0, top, 5000)
        assert (brown_lm._order(x) == np.argsort(x, kind="stable")).all()
    assert len(brown_lm._order(np.empty(0, np.int64))) == 0


# 3
def test_mix_reaches_targets(docs):
    rows = corpus()
    size = lambda t: len(re.findall(WORD, t or ""))
    by = defaultdict(int)
    for _, t, _, s in rows:
        by[s] += size(t)
    names = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    aims = dict(zip(names, mix_flow.targets([by[s] for s in names])))
    out = mix_flow.mix(docs).collect()
    assert len(out) == len(rows)
    taken = defaultdict(int)
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == by[r["source"]]
        assert r["target"] == pytest.approx(aims[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - aims[s]) <= 1 for s in names)
    again = mix_flow.mix(docs.repartition(3)).collect()
    assert sorted(map(tuple, again), key=key) == sorted(map(tuple, out), key=key)


def test_targets_share_and_stop():
    assert mix_flow.targets([100, 100, 100]) == pytest.approx([200, 250 * 1 / 3, 250 * 2 / 3])
    assert mix_flow.targets([0, 10]) == pytest.approx([0, 15]) and mix_flow.targets([]) == []


def test_route_spreads_repetition_first():
    # "a" could serve its quota from shared words alone, but its own are still unused
    flow = mix_flow.route([("own", "a", 10), ("both", "a", 10), ("both", "b", 10)],
                          {"own": 10, "both": 10}, {"a": 10, "b": 10})
    assert flow == {("own", "a"): 10, ("both", "a"): 0, ("both", "b"): 10}


def plain_flow_cost(cells, distinct, quotas, repeat):
    """Least cost of serving as much of the quotas as can be, word by word along cheapest ways; and that amount."""
    nodes = {"s", "t", *(("p", p) for p, _, _ in cells), *(("q", q) for q in quotas)}
    arcs = []  # [from, to, room, cost]

    def arc(a, b, room, cost):
        arcs.append([a, b, room, cost])
        arcs.append([b, a, 0, -cost])

    most = Counter()
    for p, q, n in cells:
        arc(("p", p), ("q", q), repeat * n, 0)
        most[p] += repeat * n
    for p, n in most.items():
        for use in range(1, -(-n // distinct[p]) + 1):
            arc("s", ("p", p), distinct[p], use)
    for q, n in quotas.items():
        arc(("q", q), "t", n, 0)
    sent = cost = 0
    while True:
        far = dict.fromkeys(nodes, math.inf)
        far["s"], by = 0, {}
        for _ in nodes:
            for i, (a, b, room, c) in enumerate(arcs):
                if room and far[a] + c < far[b]:
                    far[b], by[b] = far[a] + c, i
        if far["t"] == math.inf:
            return cost, sent
        x = "t"
        while x != "s":
            arcs[by[x]][2] -= 1
            arcs[by[x] ^ 1][2] += 1
            x = arcs[by[x]][0]
        cost, sent = cost + far["t"], sent + 1


def test_route_costs_as_little_as_a_plain_flow():
    r = random.Random(11)
    for trial in range(60):
        sources = "abc"[:r.randint(1, 3)]
        cells, distinct = [], {}
        for p in range(r.randint(1, 4)):
            members = r.sample(sources, r.randint(1, len(sources)))
            sizes = {q: r.randint(1, 6) for q in members}
            cells += [(p, q, n) for q, n in sizes.items()]
            distinct[p] = r.randint(1, max(sizes.values()))  # copies within a source: fewer distinct words
        quotas = {q: r.randint(0, 14) for q in sources}
        flow = mix_flow.route(cells, distinct, quotas, 2)
        used = Counter()
        for (p, q), n in flow.items():
            assert 0 <= n <= 2 * next(c for a, b, c in cells if (a, b) == (p, q))
            used[p] += n
        assert all(sum(n for (_, q), n in flow.items() if q == s) <= quotas[s] for s in quotas)
        cost = sum(-(-unit // distinct[p]) for p, n in used.items() for unit in range(1, n + 1))
        assert (cost, sum(used.values())) == plain_flow_cost(cells, distinct, quotas, 2), (cells, distinct, quotas)


def test_route_takes_many_uses_in_few_steps(monkeypatch):
    calls = []
    push = mix_flow._Flow.push
    monkeypatch.setattr(mix_flow._Flow, "push", lambda self, s, t: calls.append(1) or push(self, s, t))
    flow = mix_flow.route([("x", "a", 50_000), ("y", "a", 10)], {"x": 5, "y": 10}, {"a": 90_000})
    assert sum(flow.values()) == 90_000 and len(calls) < 120


def test_mix_with_more_patterns_than_are_routed_alone(spark):
    """Rarer patterns keep their joint supply, targets stay met."""
    r = random.Random(3)
    texts = [prose(i, r.randint(5, 30)) for i in range(60)]
    rows = [(10 * i + j, t, "en", f"s{q}") for i, t in enumerate(texts)
            for j, q in enumerate(r.sample(range(8), r.randint(1, 4)))]
    docs = make(spark, rows)
    got = mix_flow.mix(docs, max_patterns=3).collect()
    assert len(got) == len(rows)
    taken, aims = defaultdict(int), {}
    for x in got:
        assert 0 <= x["taken"] <= 2 * x["size"]
        taken[x["source"]] += x["taken"]
        aims[x["source"]] = x["target"]
    assert all(abs(taken[s] - aims[s]) <= 1 for s in aims)


# 4
def plain_repeats(texts, length):
    count = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                mark[s:s + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(mark)))
        kept = bytes(b for b, m in zip(t, mark) if not m)
        out.append((len(t), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [60_000, 1])
def test_repeats_are_removed(docs, hot):
    texts = [(r[1] or "").encode() for r in corpus()]
    want = [(r[0], *w) for r, w in zip(corpus(), plain_repeats(texts, 400))]
    same(column_bwt.digests(column_bwt.remove_repeats(docs, hot=hot)), want)


def test_repeats_in_very_long_texts(spark):
    """Passages that cross the borders of the parts which are hashed together, in a text of over a megabyte."""
    import numpy as np
    r = np.random.default_rng(12)
    long = bytearray(r.integers(97, 123, 1_300_000).astype(np.uint8).tobytes())
    passage = r.integers(97, 123, 900).astype(np.uint8).tobytes()
    for at in ((1 << 19) - 450, (1 << 20) - 100):  # the parts end there
        long[at:at + 900] = passage
    long[200_000:200_399] = long[700_000:700_399]  # a byte too short
    rows = [(1, long.decode(), "en", "s"), (2, "x" + passage[100:520].decode() + "y", "en", "s"), (3, "z" * 900, "en", "s")]
    texts = [t.encode() for _, t, *_ in rows]
    windows = Counter(xxhash.xxh3_128_digest(t[i:i + 400]) for t in texts for i in range(len(t) - 399))
    want = []
    for (i, *_), t in zip(rows, texts):
        mark = bytearray(len(t))
        for k in range(len(t) - 399):
            if windows[xxhash.xxh3_128_digest(t[k:k + 400])] > 1:
                mark[k:k + 400] = b"\1" * 400
        kept = bytes(np.frombuffer(t, np.uint8)[np.frombuffer(mark, np.uint8) == 0])
        want.append((i, len(t), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    same(column_bwt.digests(column_bwt.remove_repeats(make(spark, rows))), want)
    assert want[0][2] == 1800 and want[2][2] == 900


def plain_passages(texts, short, words):
    count = Counter(t[s:s + short] for t in texts for s in range(len(t) - short + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for s in range(len(t) - short + 1):
            if count[t[s:s + short]] > 1:
                mark[s:s + short] = b"\1" * short
        whole = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]
        out.append(sum(sum(m.start() <= a and b <= m.end() for a, b in whole) >= words
                       for m in re.finditer(b"\1+", bytes(mark))))
    return out


@pytest.mark.parametrize("hot", [60_000, 1])
def test_short_passages_are_reported_and_stay(spark, hot):
    """Over 50 words that repeat in under 400 bytes: the contract removes none of them, n_passages counts them."""
    passage = " ".join(prose(900, 51)[i * 6:i * 6 + 5].replace(" ", "q") for i in range(51))    # 305 bytes
    fifty = " ".join(prose(901, 51)[i * 6:i * 6 + 5].replace(" ", "q") for i in range(50))      # a word too few
    rows = [(i, f"{prose(910 + i, 40)}\n{p}\n{prose(930 + i, 40)}", "en", "s")
            for i, p in enumerate([passage] * 3 + [fifty] * 3 + [prose(950, 60)])]
    rows += [(10 + i, passage, "en", "s") for i in range(2)]                # whole texts, under 400 bytes
    rows += [(20 + i, f"{passage} {prose(960, 60)}", "en", "s") for i in range(2)]
    rows += [(30, f"{passage}x {prose(970, 9)}", "en", "s"), (31, None, "en", "s"), (32, passage[:255], "en", "s")]
    rows += [(40 + i, prose(980 + i, 9) + passage, "en", "s") for i in range(2)]   # the first word stands in another
    texts = [(r[1] or "").encode() for r in rows]
    want = [(r[0], *w, n) for r, w, n in zip(rows, plain_repeats(texts, 400), plain_passages(texts, 256, 51))]
    same(column_bwt.report(column_bwt.remove_repeats(make(spark, rows), hot=hot)), want)
    found = {w[0]: (w[2], w[-1]) for w in want}
    assert [found[i] for i in (0, 3, 6, 10, 30)] == [(0, 1), (0, 0), (0, 0), (0, 1), (0, 0)] and found[20][0] > 400


@pytest.mark.parametrize("hot", [60_000, 1])
def test_passages_of_odd_rows(docs, hot):
    texts = [(r[1] or "").encode() for r in corpus()]
    got = column_bwt.report(column_bwt.remove_repeats(docs, hot=hot)).select("doc_id", "n_bytes", "n_passages")
    same(got, [(r[0], len(t), n) for r, t, n in zip(corpus(), texts, plain_passages(texts, 256, 51))])


def test_columns_give_the_transform_and_prefixes():
    import numpy as np
    r = np.random.default_rng(4)
    d = r.integers(97, 99, (30, 40)).astype(np.uint8)
    d[7], d[21] = d[3], d[3]
    for c, order, shared, bwt in column_bwt.construct(column_bwt.Columns(d)):
        suffixes = [bytes(d[i, c:]) for i in order]
        assert suffixes == sorted(suffixes) and sorted(bwt) == sorted(d[:, c])
        for k in range(1, 30):
            a, b = suffixes[k - 1], suffixes[k]
            n = next((x for x in range(len(a)) if a[x] != b[x]), len(a))
            assert shared[k] - c == n


# 5
def plain_simhash(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[j:j + 3]) for j in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


@pytest.mark.parametrize("hot", [4096, 1])
def test_simhash_components(docs, hot):
    rows = corpus()
    fps = [plain_simhash(r[1]) for r in rows]
    group = [*range(len(rows))]

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                group[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        g = find(i)
        if r[0] is not None and (least[g] is None or r[0] < least[g]):
            least[g] = r[0]
    want = [(r[0], f - (f >> 63 << 64), least[find(i)]) for i, (r, f) in enumerate(zip(rows, fps))]
    same(simhash_cover.near_groups(docs, hot=hot), want)


@pytest.mark.parametrize("hot", [4096, 2])
def test_cover_loses_no_link(spark, hot):
    r = random.Random(5)
    seeds = [r.getrandbits(64) for _ in range(30)]
    fps = {s ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for s in seeds for _ in range(12)}
    df = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long")
    found = simhash_cover.components(simhash_cover.links(df, hot)).collect()
    root = {x["node"]: x["root"] for x in found}
    signed = [f - (f >> 63 << 64) for f in fps]
    for a in signed:
        for b in signed:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3 and a != b:
                assert root[a] == root[b]


def test_near_copies_leave_one_row(docs):
    groups = {r["component_id"] for r in simhash_cover.near_groups(docs).collect()}
    kept = simhash_cover.drop_near_copies(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == groups
    assert kept.count() == len(groups)


def test_pipeline_keeps_one_of_each_near_group(spark):
    """The stage goes by its contract: three-word shingles, links at three bits or fewer, also over several steps."""
    r, texts = random.Random(3), []
    for i in range(25):
        base = prose(500 + i, r.randint(60, 200)).split()
        texts.append(base)
        for _ in range(5):
            base = list(base)
            for at in r.sample(range(len(base)), r.randint(1, 2)):
                base[at] = r.choice(["changed", "other"])
            texts.append(base)
    fps = [plain_simhash(" ".join(w)) for w in texts]
    group = [*range(len(texts))]
    for i in range(len(texts)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                old, new = sorted((group[i], group[j]))[::-1]
                group = [new if g == old else g for g in group]
    far = sum((fps[i] ^ fps[g]).bit_count() > 3 for i, g in enumerate(group))
    assert far and 25 < len(set(group)) < len(texts) - 10
    df = make(spark, [(i, " ".join(w), "en", "s") for i, w in enumerate(texts)])
    kept = dict(corpus_pipeline.STAGES[2:3]).popitem()[1](spark, df, "")
    assert kept.columns == df.columns and sorted(x["doc_id"] for x in kept.collect()) == sorted(set(group))


# 6
def plain_counts(text):
    text = text or ""
    w = re.findall(WORD, text)
    seen, cover = Counter(zip(w, w[1:], w[2:])), set()
    for j in range(len(w) - 2):
        if seen[w[j], w[j + 1], w[j + 2]] > 1:
            cover |= {j, j + 1, j + 2}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(cover), failed)


def test_quality_counts(docs, spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    out = quality_risk.judge(docs, labels)
    same(out.drop("kept"), [(r[0], *plain_counts(r[1])) for r in corpus()])
    assert all(r["kept"] != r["base_failed"] for r in out.collect())  # too few labels: only the base rule


def test_binomial_tail(spark):
    for n, k, p in ((100, 0, 0.05), (100, 3, 0.05), (5000, 10, 0.004)):
        plain = math.log(sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)))
        row = spark.range(1).select(F.lit(n).cast("long").alias("n"), F.lit(k).cast("long").alias("k")).select(
            quality_risk.log_binomial_tail(F.col("n"), F.col("k"), p)).first()
        assert row[0] == pytest.approx(plain, rel=1e-9)


def test_quality_cutoffs_hold_the_risk(spark):
    good, bad = prose(1, 80), " ".join("#$%& word" for _ in range(60))
    rows = [(i, good + f" {i}", "en", "s") for i in range(4000)] + [(5000 + i, bad + f" {i}", "en", "s") for i in range(50)]
    df = make(spark, rows)
    labels = spark.createDataFrame([(r[0], int(r[0] < 5000)) for r in rows], "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality_risk.keep_good(df, labels).select("doc_id").collect()}
    assert kept >= set(range(4000))
    clean = quality_risk.judge(df, labels).where("doc_id >= 5000").select("base_failed", "kept").distinct().collect()
    assert not any(r["kept"] for r in clean)


def test_quality_cutoffs_for_small_strata(spark):
    """Languages of a few hundred labels have cutoffs, alone or pooled, though none has thousands."""
    spread = [("en", 450), ("fr", 450), ("de", 440), ("es", 307), (None, 20)]
    rows = [(lang, q, 100, 500, 60 * (1 - q), 10, 0, 0) for lang, n in spread for q in [1] * n + [0] * 30]
    df = spark.createDataFrame(rows, "lang string, quality int, n_words long, word_chars long, n_symbols long, "
                                     "n_lines long, n_dup_lines long, n_repeat_words long")
    strata, chosen = quality_risk.cutoffs(df)
    assert {r["lang"] for r in strata.collect()} == {"en", "fr"}  # 327 others are too few, so de joins them
    found = {r["stratum"]: r for r in chosen.collect()}
    assert set(found) == {"en", "fr", None} and found[None]["n"] == 767
    assert all(r["rule"] == "symbols" and r["k"] == 0 for r in found.values())
    assert quality_risk.own_strata([4000, 3000], 0) == 2 and quality_risk.own_strata([450, 100], 0) == 0


def test_quality_sequences_hold_the_risk(spark):
    """Good documents beyond the loosest cutoff are never given up beyond the bound."""
    rows = [("en", q, 100, 500, 300 if q == 0 or i % 20 == 0 else 0, 10, 0, 0)
            for q, n in ((1, 2000), (0, 100)) for i in range(n)]
    df = spark.createDataFrame(rows, "lang string, quality int, n_words long, word_chars long, n_symbols long, "
                                     "n_lines long, n_dup_lines long, n_repeat_words long")
    assert quality_risk.cutoffs(df)[1].count() == 0


# 7
def test_bpe_equals_the_library(docs):
    import tokenizers

    t = tokenizers.Tokenizer.from_file(bpe_speculate.TOKENIZER)
    odd = ["<|startoftext|>a b<|endoftext|>", "ΑΣ ΣΑΣ", "don't CAN'T 's'S", "</w> w>", "１２３ ² 日本語", "a\x1cb",
           "a\xa0b\u0085c", "a" * 3000, "".join(random.Random(1).choices("abcde", k=3000))]
    texts = odd + [r[1] or "" for r in corpus()]
    model = bpe_speculate.SpeculativeBpe(open(bpe_speculate.TOKENIZER, encoding="utf-8").read())
    for text, (ids, n, decoded) in zip(texts, model.encode_all([x.encode() for x in texts])):
        want = t.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)).encode() and n == len(want)
        assert decoded.decode() == t.decode(want, skip_special_tokens=False)
    assert 0 < model.merged_words < model.seen_words
    out = {r["doc_id"]: r for r in bpe_speculate.encode_digests(docs).collect()}
    assert out[161]["n_tokens"] == 0 and out[161]["ids_sha256"] == hashlib.sha256(b"").hexdigest()


# 8
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and luhn) or kind == "phone" and not 8 <= len(d) <= 15:
                continue
            yield f"{kind}:{m.start()}:{m.end()}"


def test_pii_base_spans(spark):
    r = random.Random(8)
    bits = ["a.b@c-d.ef", "x@y", "@", ".", "1.2.3.4", "256.1.1.1", "007.08.255.0", "4111 1111 1111 1111", "4111111111111111",
            "4111-1111-1111-1112", "+1 (202) 555-1015", "+12", "+", " ", "é", "12345678901234567890", "-", "a_b", "1", "\ue000"]
    texts = ["".join(r.choices(bits, k=r.randint(1, 14))) for _ in range(400)] + ["", None, "9" * 5000, "a" * 5000 + "@b.c"]
    df = make(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    out = pii_votes.summary(pii_votes.find_pii(df)).collect()
    for row in out:
        want = [*plain_spans(texts[row["doc_id"]] or "")]
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[row["doc_id"]]
        assert set(want) <= set(filter(None, row["spans"].split(",")))


def test_pii_rounds_equal_a_plain_model(spark):
    r = random.Random(4)
    cells = {(k, *[r.randint(0, 1) for _ in range(3)], r.randint(0, 4), r.randint(0, 4)): r.randint(1, 50) for k in
             list(pii_votes.LOOSE)[:2] for _ in range(12)}
    rows = [(*k, n) for k, n in cells.items()]
    got = pii_votes.reliabilities(spark.createDataFrame(
        rows, "kind string, strict int, known int, near int, size int, digits int, n long"), 7).collect()
    for kind in {k[0] for k in cells}:
        own = [(k[1:4], n) for k, n in cells.items() if k[0] == kind]
        prior, rates = 0.5, [[0.1, 0.9] for _ in range(3)]

        def posterior(votes):
            like = [1 - prior, prior]
            for v, rate in zip(votes, rates):
                for z in (0, 1):
                    like[z] *= rate[z] if v else 1 - rate[z]
            return like[1] / sum(like)

        for _ in range(7):
            p = [posterior(v) for v, _ in own]
            mass = [sum(n * (1 - x) for (_, n), x in zip(own, p)), sum(n * x for (_, n), x in zip(own, p))]
            prior = (mass[1] + 1) / (sum(mass) + 2)
            rates = [[(sum(n * (x if z else 1 - x) * v[i] for (v, n), x in zip(own, p)) + 0.5) / (mass[z] + 1) for z in (0, 1)]
                     for i in range(3)]
        for x in got:
            if x["kind"] == kind:
                assert x["p"] == pytest.approx(posterior((x["strict"], x["known"], x["near"])), abs=1e-9)


def test_pii_long_secrets_are_candidates(spark):
    texts = ["password = " + ("Ab3" * 40)[:n] for n in (16, 64, 80, 110)] + ["x " + "a" * 5000 + " 1", "ghp_" + "aB1" * 33]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = df.select("doc_id", pii_votes.candidates(F.col("text")).alias("c")).collect()
    assert [[(c["kind"], c["end"] - c["at"]) for c in r["c"]] for r in sorted(out)] == [
        [("secret", 16)], [("secret", 64)], [("secret", 80)], [("secret", 110)], [], [("secret", 103)]]


def test_pii_votes_add_what_labelers_agree_on(spark):
    yes = [f"text {i} password = Ab3x9Qz7Lm2Kp8T{i % 10}w end" for i in range(60)]
    no = [f"see 20{i % 10}-report-about-thing-n for more" for i in range(300)]
    df = make(spark, [(i, t, "en", "s") for i, t in enumerate(yes + no)])
    out = pii_votes.find_pii(df).select("doc_id", F.size("added").alias("n")).collect()
    assert {r["doc_id"] for r in out if r["n"]} == set(range(60))


# 9
def test_exact_copies(docs):
    rows = corpus()
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    groups = defaultdict(list)
    for r, t in zip(rows, norm):
        groups[t].append(r[0])
    want = []
    for t, ids in groups.items():
        ids.sort(key=lambda x: (x is None, x))
        want += [(i, bytearray(hashlib.sha256(t.encode()).digest()), ids[0], len(ids), k == 0) for k, i in enumerate(ids)]
    for counters in (1024, 4):  # with four counters groups become heavy and are settled by broadcast
        same(exact_dedup.mark_copies(docs, counters), want)
        kept = exact_dedup.drop_copies(docs, counters)
        assert kept.columns == docs.columns and kept.count() == len(groups)


def test_misra_gries_keeps_heavy_hitters():
    import pyarrow as pa
    r = random.Random(9)
    items = [b"hot"] * 400 + [b"%d" % r.randrange(10**6) for _ in range(600)]
    r.shuffle(items)
    batches = [pa.RecordBatch.from_arrays([pa.array(items[i:i + 50], pa.binary())], names=["digest"]) for i in range(0, 1000, 50)]
    out = {d: n for b in exact_dedup.misra_gries(batches, 9) for d, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert len(out) <= 9 and 400 - 1000 / 10 <= out[b"hot"] <= 400


# 10
@pytest.mark.parametrize("max_words", [1 << 20, 2])
def test_urls(spark, max_words):
    urls = ["http://A.Org/x", "https://example.org/es/1", "https://www.example.org/en/12", "http://a.com/fr/", "x.com/de/",
            "http://a.com/de/1?q", "http://notorg/", "http://org", None, "", "ftp://h.net/p?page=2", "http://h.net/p",
            "http://h.net/q#page=1", "://", "http://u@b.net:80/a://b"] + [f"http://n{i}.net/{i}" for i in range(300)] + [
            f"http://n{i}.net/{i}?page=1" for i in range(0, 300, 7)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")

    def split(u):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        return ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")

    listed = {"".join(split(u)) for u in urls if u and re.search(r"^[^?#]*\?([^#]*&)?page=", u)}
    want = []
    for i, u in enumerate(urls):
        h, p = split(u)
        fits = [(len(a + b), a + b, v) for v, a, b in bloom_cascade.RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
        _, rule, verdict = max(fits, default=(0, None, "block" if h + p in listed else "allow"))
        want.append((i, h, p, rule, verdict))
    same(bloom_cascade.judge_urls(pages, bloom_cascade.paged_keys(pages), max_words=max_words), want)


def test_clashing_columns_and_ids_of_pages(spark):
    rows = [(1, "http://a.com/fr/x", "h", "r", "p", "v", "k"), (None, "http://n.net/1?page=2", "h", "r", "p", "v", "k"),
            (1, "http://a.com/fr/x", "h", "r", "p", "v", "k"), (2, "http://N.net/1", None, None, None, None, None),
            (None, None, "h", "r", "p", "v", "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string, path string, verdict string, key string")
    same(bloom_cascade.judge_urls(pages, bloom_cascade.paged_keys(pages)), [
        (1, "a.com", "/fr/x", "com/fr/", "allow"), (1, "a.com", "/fr/x", "com/fr/", "allow"), (None, "n.net", "/1", None, "block"),
        (2, "n.net", "/1", None, "block"), (None, "", "", None, "allow")])


def test_clashing_columns_of_labels(spark, docs):
    plain = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    extra = plain.withColumns({c: F.lit("x") for c in ("text", "lang", "kept", "n_words", "source", "word_chars")})
    judged = [sorted((tuple(r) for r in quality_risk.judge(docs, x).collect()), key=key) for x in (plain, extra)]
    assert judged[0] == judged[1]


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    pages = spark.createDataFrame([], "page_id long, url string")
    for out in (license_scan.summary(license_scan.find_licenses(none)), brown_lm.score(none, rounds=1), mix_flow.mix(none),
                column_bwt.digests(column_bwt.remove_repeats(none)), simhash_cover.near_groups(none),
                quality_risk.judge(none, labels), bpe_speculate.encode_digests(none), pii_votes.summary(pii_votes.find_pii(none)),
                exact_dedup.mark_copies(none), bloom_cascade.judge_urls(pages, bloom_cascade.paged_keys(pages))):
        assert out.count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [r for r in corpus() if not plain_counts(r[1])[-1]]
    seen, exact = {}, []
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1]), r) is r:
            exact.append(r)
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        kept.append(sorted((r["doc_id"] for r in now.collect()), key=lambda x: (x is None, x or 0)))
    order = lambda ids: sorted(ids, key=lambda x: (x is None, x or 0))
    assert kept[0] == order(r[0] for r in rows) and kept[1] == order(r[0] for r in exact)
    near = []
    for r in exact:  # the smallest id of each group comes first
        if all((plain_simhash(r[1]) ^ plain_simhash(x[1])).bit_count() > 3 for x in near):
            near.append(r)
    assert kept[2] == order(r[0] for r in near) and set(kept[3]) <= set(kept[2])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept[3])
