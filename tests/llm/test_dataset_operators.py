"""Filter audit, nearest-neighbour quality and Merkle manifest against plain versions."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import permutations

import duckdb
import numpy as np
import pytest

from newslens.llm import knn_quality, merkle_blocks, trie_audit
from newslens.llm.queries import OP11_SQL, OP13_SQL
from tests.llm.test_operators import corpus, make, prose, same

LABELS = "doc_id long, quality int, toxic int, mask int, n string"


@pytest.fixture(scope="module")
def docs(spark):
    return make(spark, corpus()).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 5 != 0), int(i % 7 == 0), 1, "x") for i in range(0, 170, 2)]
    rows += [(4, 1, 1, 0, "x"), (4, 0, 0, 0, "x"), (None, 1, 1, 0, "x"), (100, None, None, 0, None), (9999, 1, 1, 0, "x")]
    return spark.createDataFrame(rows, LABELS).cache()


# 11
def test_trie_terminals_equal_a_dictionary():
    r = random.Random(4)
    texts = ["".join(r.choices("ab", k=r.randint(0, 9))).encode() for _ in range(3000)]
    texts += [b"a" * n for n in range(200)] + ["é語".encode(), "é".encode(), "ê".encode()] * 2
    trie, known = trie_audit.Trie(), {}
    for text in texts:
        assert trie.add(text) == known.setdefault(text, len(known))
    assert trie.size == len(known)


def test_shared_prefix():
    assert trie_audit.shared(b"", b"a") == 0 and trie_audit.shared(b"abc", b"abd") == 2
    assert trie_audit.shared(b"ab", b"ab") == 2 and trie_audit.shared(b"ab", b"abc") == 2


def plain_audit(rows, labels):
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    marks = defaultdict(lambda: [0, 0])
    for i, quality, toxic, *_ in labels:
        if i is not None:
            marks[i] = [max(a, int(b == 1)) for a, b in zip(marks[i], (quality, toxic))]
    counted = defaultdict(Counter)
    order_of = list(permutations("ABCDE"))
    for i, text, _, source in rows:
        text, part = text or "", source or ""
        words = text.encode().split()
        least = first.get(text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": least is not None and (i is None or i > least)}
        good, bad = marks[i] if i in marks else (0, 0)
        for order in order_of:
            gone = False
            for step, letter in enumerate(order, 1):
                cell = counted[part, "".join(order), step]
                cell["rows"] += 1
                if fails[letter]:
                    cell["redundant" if gone else "removed"] += 1
                    if not gone:
                        cell["good"] += good
                        cell["bad"] += bad
                        counted[part, letter]["all"] += 1
                    if sum(fails.values()) == 1:
                        cell["unique"] += 1
                    gone = True
                if not gone:
                    cell["kept"] += 1
    return [(*k, c["kept"], c["removed"], c["redundant"], c["unique"], c["good"], c["bad"], counted[k[0], k[1][k[2] - 1]]["all"])
            for k, c in list(counted.items()) if len(k) == 3]


def test_audit_equals_plain(docs, labels):
    same(trie_audit.audit(docs, labels), plain_audit(corpus(), [tuple(r) for r in labels.collect()]))


@pytest.mark.parametrize("limit, bucket", [("BYTES", 1), ("BYTES", 5000), ("ROWS", 3)])
def test_audit_with_crowded_prefixes(spark, monkeypatch, limit, bucket):
    """Long shared beginnings are cut again, crowds of equal texts settled by their minimum."""
    monkeypatch.setattr(trie_audit, f"BUCKET_{limit}", bucket)
    same_start = prose(1, 80)
    rows = [(i, same_start + "x" * (i % 9), "en", "s1") for i in range(40)]
    rows += [(50 + i, "a" * i, "en", None) for i in range(30)] + [(None, "aaa", "en", "s1"), (None, same_start, "en", "s2")]
    rows += [(90 + i, same_start, "en", "s2") for i in range(20)] + [(3, same_start, "en", "s2")] * 3
    rows += [(200, "é" * 50 + "ü", "en", "s1"), (201, "é" * 50 + "û", "en", "s1"), (202, "é" * 50 + "ü", "en", "s3")]
    docs, none = make(spark, rows).repartition(5), spark.createDataFrame([], LABELS)
    same(trie_audit.audit(docs, none), plain_audit(rows, []))


def test_audit_of_nothing(spark, labels):
    assert trie_audit.audit(make(spark, []), labels).count() == 0


def test_audit_equals_sql(docs, labels):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("labels", labels.toArrow())
    same(trie_audit.audit(docs, labels), con.execute(OP11_SQL).fetchall())


# 12
def brute_votes(vectors, known, label, weight):
    out = []
    for v in vectors:
        norm = np.linalg.norm(v)
        sims = [float(np.dot(v, x)) / (norm or 1) for x in known]
        last = sorted(sims, reverse=True)[:knn_quality.NEIGHBOURS][-1]
        votes = [(max(s, 1e-6) ** knn_quality.POWER * w, y) for s, w, y in zip(sims, weight, label) if s >= last - 1e-6]
        out.append(sum(v * y for v, y in votes) / sum(v for v, _ in votes))
    return out


def test_votes_equal_brute_force():
    r = np.random.default_rng(3)
    known = knn_quality.unit(r.standard_normal((90, 8)))
    known[40:60] = known[:20]  # ties
    label, weight = (r.random(90) < 0.6).astype(float), r.random(90) + 0.5
    vectors = np.vstack([r.standard_normal((30, 8)), np.zeros((1, 8)), known[:3] * 7])
    assert np.allclose(knn_quality.votes(vectors, known, label, weight), brute_votes(vectors, known, label, weight))


def test_latent_space_spans_the_largest_directions():
    r = np.random.default_rng(5)
    rows = (r.standard_normal((60, 5)) @ r.standard_normal((5, 40)) + 0.01 * r.standard_normal((60, 40))).astype(np.float32)
    space = knn_quality.latent_space(rows, 5)
    exact = np.linalg.svd(rows, full_matrices=False)[2][:5]
    assert np.allclose(np.linalg.svd(exact @ space)[1], 1, atol=1e-3)


def test_terms_and_frequencies():
    at, tf = knn_quality.terms("Ab ab\tcd 99 ##".encode())
    words = Counter(zlib.crc32(w) % knn_quality.WORDS for w in (b"ab", b"ab", b"cd", b"99", b"##"))
    assert {int(a): int(n) for a, n in zip(at, tf) if a < knn_quality.WORDS} == words
    assert list(at) == sorted(set(at)) and knn_quality.terms(b"")[0].min() >= knn_quality.WORDS


def quality_rows(n=400):
    r = random.Random(9)
    rows, marks = [], []
    for i in range(n):
        good = r.random() < 0.7
        text = prose(1000 + i, r.randint(60, 200))
        if not good:
            text = " ".join(w + r.choice(["$$$", "###"]) for w in text.split()) if i % 2 else " ".join([text[:8]] * 90)
        rows.append((i, text, "en", "s"))
        marks.append((i, int(good), 0, 0, "x"))
    return rows, marks


def test_held_out_accuracy_and_odd_rows(spark):
    rows, marks = quality_rows()
    odd = [(None, "one two", None, None), (None, None, None, None), (1000, "", "en", "s"), (1001, "ab " * 40_000, "en", "s"),
           (7, rows[7][1], "en", "s")]
    docs = make(spark, rows + odd)
    labels = spark.createDataFrame(marks + [(1000, None, 1, 0, "x"), (None, 1, 1, 0, "x")], LABELS)
    out = knn_quality.score(docs, labels).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out)
    truth = {i: q for i, q, *_ in marks}
    held = [r for r in out if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert held and all(r["held_out"] for r in held)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert not any(r["held_out"] for r in out if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5)


def test_scores_do_not_read_held_out_labels(spark):
    rows, marks = quality_rows(150)
    docs = make(spark, rows)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, *x) for i, q, *x in marks]
    a, b = (knn_quality.score(docs, spark.createDataFrame(m, LABELS)).collect() for m in (marks, turned))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_quality_without_labels_or_documents(spark):
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in knn_quality.score(make(spark, corpus()), none).collect()} == {0.5}
    assert knn_quality.score(make(spark, []), none).count() == 0


# 13
def test_addresses_fill_each_tree_once():
    for levels in range(1, 5):
        places = [int(merkle_blocks.address(levels, d, i)) for d in range(levels) for i in range(merkle_blocks.FAN ** d)]
        assert sorted(places) == list(range(merkle_blocks.nodes_in(levels))) and places[0] == 0
    # upper half first, then whole subtrees one behind the other
    assert [int(merkle_blocks.address(4, 2, i)) for i in (0, 1, 16)] == [17, 34, 289]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def plain_path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 16 * 16
        out.append((level[first:i], level[i + 1:first + 16]))
        i //= 16
    return out


def plain_proofs(rows):
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for i, text, lang, source in rows:
        head = [field(x) for x in (i, source, lang, len(text or ""))]
        leaf = h(*head, field(text))
        tampers = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        used = h(*head, field(text and text.translate(lower))) if tampers else leaf
        groups[source].append(((i is not None, i or 0), leaf, i, used))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[1] for x in sorted(groups[s], key=lambda x: x[:2])]) for s in order}
    over = plain_tree([trees[s][-1][0] for s in order])
    root, out = over[-1][0], []
    for place, s in enumerate(order):
        for n, (_, leaf, i, used) in enumerate(sorted(groups[s], key=lambda x: x[:2])):
            way = plain_path(trees[s], n) + plain_path(over, place)
            for a, b in way:
                used = h(*a, used, *b)
            out.append((i, leaf, trees[s][-1][0], root, h(*[x for a, b in way for x in a + b]), used, used == root))
    return out


def test_proofs_equal_plain_and_sql(docs):
    want = plain_proofs(corpus())
    same(merkle_blocks.document_proofs(docs), want)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    same(merkle_blocks.document_proofs(docs), con.execute(OP13_SQL).fetchall())


@pytest.mark.parametrize("n", [2, 16, 257, 4096, 4097])
def test_proofs_at_the_edges_of_blocks(spark, n):
    rows = [(i, f"T{i}", "en", "big") for i in range(n)] + [(n + i, "é", None, f"s{i}") for i in range(17)]
    same(merkle_blocks.document_proofs(make(spark, rows).repartition(3)), plain_proofs(rows))


def test_proofs_of_many_sources(spark):
    rows = [(i, "T", "en", f"s{i}") for i in range(4100)]
    same(merkle_blocks.document_proofs(make(spark, rows).repartition(3)), plain_proofs(rows))


def test_proofs_of_one_or_no_document(spark):
    same(merkle_blocks.document_proofs(make(spark, [(5, "One", None, None)])), plain_proofs([(5, "One", None, None)]))
    out = merkle_blocks.document_proofs(make(spark, []))
    assert out.count() == 0 and out.columns[-1] == "verified"
