"""Merkle manifest, conversation trie and n-gram join against plain versions."""

import hashlib
import random
import re
import zlib
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import conversation_trie, merkle, ngram_join, queries
from skyledger.llm.common import words_of
from skyledger.llm.ngram_join import CountTree, linked, links_of_block, pairs_below, points

DOCS = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, tree STRING, h STRING, pos INT"
TALK = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, node STRING, key STRING, n INT"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def run(spark, rows, schema, table, query, tmp_path):
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(str(tmp_path / f"{table}.parquet"))
    df = query(spark, str(tmp_path))
    return df.columns, sorted(map(tuple, df.collect()), key=repr)


# Merkle manifest


def plain_manifest(rows):
    """Contract rows of (doc_id, source, lang, n_chars, text), node by node."""

    def leaf(row, lower=False):
        text = row[4]
        if lower and text is not None:
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        return sha("".join(map(told, (*row[:4], text))))

    def climb(nodes):
        """Root, and per leaf its (place, run) on each level."""
        ways = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
            for k, way in enumerate(ways):
                way.append((at[k] % 16, runs[at[k] // 16]))
                at[k] //= 16
            nodes = [sha("".join(run)) for run in runs]
        return nodes[0], ways

    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        kept = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = kept, *climb([leaf(r) for r in kept])
    if not names:
        return []
    root, tops = climb([trees[n][1] for n in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        kept, subroot, ways = trees[name]
        for row, way in zip(kept, ways, strict=True):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node, siblings = leaf(row, tampered), ""
            for place, nodes in way + top:
                rest = nodes[:place] + nodes[place + 1 :]
                siblings += "".join(rest)
                node = sha("".join(nodes[:place] + [node] + nodes[place + 1 :]))
            out.append((row[0], leaf(row), subroot, root, sha(siblings), node, node == root))
    return sorted(out, key=repr)


def test_manifest_equals_a_plain_one(spark, tmp_path):
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(300)]
    rows += [(i, f"s{i % 19}", None, None, "lower only" if i % 2 else "Ä UPPER") for i in range(300, 360)]
    rows += [(1000, None, None, None, None), (1001, "", "", 0, ""), (1002, "", "x", 1, "A" * 100_000)]
    rows += [(1003, "tie", "a", 1, "one"), (1003, "tie", "a", 1, "two"), (1003, "tie", "a", 1, "one")]
    rows += [(None, "hot", "en", 1, "no id"), (1005, "alone", "en", 1, "A leaf is its own root")]
    extra = [(*r, "tree", "h", 7) for r in rows]
    columns, found = run(spark, extra, DOCS, "documents", queries.op11_merkle, tmp_path)
    assert columns[:4] == ["doc_id", "leaf", "subroot", "root"]
    assert found == plain_manifest(rows)
    assert {verified for *_, verified in found} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4097])
def test_forest_of_any_height(spark, tmp_path, n):
    rows = [(i, "s", "en", i, f"T{i}") for i in range(n)]
    _, found = run(spark, [(*r, "", "", 0) for r in rows], DOCS, "documents", queries.op11_merkle, tmp_path)
    assert found == plain_manifest(rows)


def test_manifest_of_nothing(spark, tmp_path):
    assert run(spark, [], DOCS, "documents", queries.op11_merkle, tmp_path)[1] == []


def test_proofs_hold_the_siblings(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, f"T{i}") for i in range(40)], DOCS[: DOCS.index(", tree")])
    made = merkle.manifest(docs)
    for row in merkle.proofs(made).collect():
        assert len(row.siblings) == merkle.DIGEST * sum(r - 1 for r in row.runs)
        assert all(0 <= p < r <= merkle.FANOUT for p, r in zip(row.places, row.runs, strict=True))


# Conversation trie


def plain_trie(rows):
    """Contract rows, from every prefix of every rebuilt conversation."""
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in talks.items():
        talks[conv] = [t[2:] for t in sorted(turns)]
    rebuilt = {}
    for conv, turns in talks.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = (*talks.get(conv - conv % 100, [])[:h], *turns[h:])
    members = {}
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
    below = {node: [m for m in members if len(m) == len(node) + 1 and m[:-1] == node] for node in members}

    def subtree(node):
        yield node
        for child in below[node]:
            yield from subtree(child)

    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == node)
        under = list(subtree(node))
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in under if m)
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(not below[m] for m in under)
        out.append((min(convs), len(node), parent, len(convs), len(below[node]), leaves, saved, sha(ends)))
    return sorted(out, key=repr)


def talk(seed, n):
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        texts = [draw.choice(["a", "bb", "ä€", ""]) for _ in range(draw.randrange(1, 9))]
        rows += [(conv, k, draw.choice(["user", None]), t) for k, t in enumerate(texts)]
    return rows


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
def test_trie_equals_a_plain_one(spark, tmp_path, monkeypatch, block_rows):
    rows = talk(5, 230)
    rows += [(c, k, "user", f"copied {k}") for c in range(500, 560) for k in range(7)]
    rows += [(900, None, "user", None), (900, 1, None, "x" * 50_000), (900, 1, None, "x" * 50_000)]
    rows += [(901, 3, "b", "tie"), (901, 3, "a", "tie"), (None, 1, "user", "in no conversation")]
    rows += [(1201, 0, "user", "no base")]
    monkeypatch.setattr(conversation_trie, "BLOCK_ROWS", block_rows)
    extra = [(*r, "node", "key", 1) for r in rows]
    columns, found = run(spark, extra, TALK, "conversations", queries.op12_conversation_trie, tmp_path)
    assert columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    assert found == plain_trie(rows)


def test_trie_of_nothing(spark, tmp_path):
    assert run(spark, [], TALK, "conversations", queries.op12_conversation_trie, tmp_path)[1] == []


@pytest.mark.parametrize("block", [1, 2, 5, 1000])
def test_blocks_of_any_size_merge_to_one_forest(block):
    """Sums over open nodes do not depend on where the sorted strings are cut."""
    draw = random.Random(block)
    unit = conversation_trie.UNIT
    texts = sorted({tuple(draw.randrange(3) for _ in range(draw.randrange(7))) for _ in range(150)})
    keys = [b"".join(bytes(unit - 1) + bytes([c]) for c in t) for t in texts]
    merged = {}
    for at in range(0, len(keys), block):
        part = keys[at : at + block]
        n = len(part)
        rows = conversation_trie.nodes_of(
            at,
            part,
            list(range(at, at + n)),
            [1] * n,
            [""] * n,
            keys[at - 1] if at else None,
            keys[at + n] if at + n < len(keys) else None,
        )
        for row in rows:
            same = merged.setdefault(row[1] or (at, row[3], row[4]), [row[3], row[4], 0, 0, 0, 0])
            same[1] = min(same[1], row[4])
            for k in range(4):
                same[2 + k] += row[6 + k]
    whole = conversation_trie.nodes_of(0, keys, list(range(len(keys))), [1] * len(keys), [""] * len(keys), None, None)
    expected = sorted([row[3], row[4], *row[6:10]] for row in whole)
    assert sorted(merged.values()) == expected


# N-gram join


def plain_sets(texts, size):
    out = []
    for text in texts:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
        n = max(1, len(w) - size + 1) if w else 0
        out.append({tuple(w[i : i + size]) for i in range(n)})
    return out


def plain_components(sets, percent):
    label = list(range(len(sets)))
    for _ in sets:
        was = list(label)
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= percent * len(x | y):
                    label[a] = min(label[a], label[b])
        if was == label:
            return label
    return label


def near_texts(seed, n_words, copies, edits):
    """A text and copies of it with a few words replaced: similarities on both sides of 0.85."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(n_words)]
    out = [" ".join(base)]
    for k in range(copies):
        copy = list(base)
        for _ in range(draw.randrange(edits)):
            copy[draw.randrange(n_words)] = f"x{seed}_{k}_{draw.randrange(10**6)}"
        out.append(" ".join(copy[draw.randrange(3) :]))
    return out


@pytest.mark.parametrize("block", [2, 11, 2048])
def test_join_equals_brute_force(spark, monkeypatch, block):
    """With large clusters cut into blocks, too."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = [t for s in range(6) for t in near_texts(s, (7, 20, 45, 90, 150, 400)[s], 24, (2, 3, 4, 5, 7, 14)[s])]
    texts += ["", None, " \n", "one", "ONE", "one two", "one two three four", "a a a a a a a a a", "a " * 30_000]
    texts += [texts[0], texts[0].upper(), texts[30] + "\t"]
    rows = [(i, t, 1, "c", 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n INT, class STRING, bucket INT").repartition(4)
    sets = plain_sets(texts, ngram_join.SHINGLE)
    label = plain_components(sets, 85)
    found = ngram_join.similar_documents(docs)
    assert set(map(tuple, found.collect())) == {(i, len(s), label[i]) for i, s in enumerate(sets)}


def test_components_of_chains_stars_and_rings(spark):
    draw = random.Random(4)
    names = draw.sample(range(10**6), 700)
    links = list(pairwise(names[:300])) + [(names[300], x) for x in names[301:500]]
    links += [(a, b) for a, b in pairwise([*names[500:600], names[500]])]
    links += [tuple(draw.sample(names[600:], 2)) for _ in range(60)]
    label = {x: x for link in links for x in link}
    for _ in range(len(label)):
        low = {x: min(label[x], *(label[b] if a == x else label[a] for a, b in links if x in (a, b))) for x in label}
        if low == label:
            break
        label = low
    found = ngram_join.components(spark.createDataFrame(links, "a BIGINT, b BIGINT"))
    assert dict(map(tuple, found.collect())) == label


def test_join_of_nothing_and_of_missing_ids(spark):
    kind = "doc_id BIGINT, text STRING"
    assert ngram_join.similar_documents(spark.createDataFrame([], kind)).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (None, text + " more"), (4, text), (4, text), (5, None), (6, "other")]
    found = ngram_join.similar_documents(spark.createDataFrame(rows, kind)).collect()
    label = [(r.doc_id, r.component_id) for r in found]
    assert sorted(label, key=repr) == sorted([(None, 4), (None, 4), (4, 4), (4, 4), (5, 5), (6, 6)], key=repr)


def test_linked_sets_always_share_a_signature():
    """Also at the very edge of the similarity, for sizes at the edges of bands."""
    draw = np.random.default_rng(3)
    for size in [*range(6, 60), 99, 118, 500, 3000]:
        for _ in range(6):
            base = draw.integers(0, 1 << 63, size).astype(np.uint64)
            cut = draw.integers(0, 3 * size // 17 + 1)  # replaced or added
            a = np.unique(base)
            fresh = draw.integers(0, 1 << 63, size).astype(np.uint64)
            b = np.unique(np.concatenate([base[cut // 2 :], fresh[: cut - cut // 2]]))
            both = len(np.intersect1d(a, b))
            if linked(both, len(a), len(b)) and not np.array_equal(a, b):
                first, second = ngram_join.signatures_of([a, b])
                assert len(np.intersect1d(first, second)), (size, cut)


def test_sets_in_few_groups_share_a_signature(monkeypatch):
    """With all shingles in one group, the first shingles in hash order must do."""
    monkeypatch.setattr(ngram_join, "_GROUP_SEED", np.uint64(0))
    monkeypatch.setattr(ngram_join, "mix", lambda x: x)
    a = np.arange(1, 41, dtype=np.uint64) * np.uint64(5040)
    b = np.concatenate([a[1:], np.array([41 * 5040], np.uint64)])
    first, second = ngram_join.signatures_of([a, b])
    assert len(np.intersect1d(first, second))


def test_tree_search_finds_what_brute_force_finds():
    draw = np.random.default_rng(9)
    sets = []
    for _ in range(60):
        base = draw.integers(0, 1 << 40, draw.integers(10, 200)).astype(np.uint64)
        for _ in range(5):
            gone = draw.integers(0, max(1, len(base) // 6))
            more = draw.integers(0, 1 << 40, gone).astype(np.uint64)
            sets.append(np.unique(np.concatenate([base[gone // 2 :], more])))
    counts, sizes = points(sets), np.array([len(s) for s in sets])
    everyone = np.arange(len(sets))
    pairs = [(i, j) for i in everyone for j in everyone[:i]]
    true = {
        frozenset(p) for p in pairs if linked(len(np.intersect1d(*(sets[k] for k in p))), *(sizes[k] for k in p))
    }
    tree = CountTree(counts, sizes)
    kept = [(tree.order[i], tree.order[j]) for a, b in pairs_below(tree, tree) for i, j in zip(a, b, strict=True)]
    assert len(kept) == len({frozenset(p) for p in kept})
    assert true <= {frozenset(p) for p in kept}
    assert len(kept) < len(pairs) / 4
    half = len(sets) // 2
    one, two = CountTree(counts[:half], sizes[:half]), CountTree(counts[half:], sizes[half:])
    across = {
        frozenset((one.order[i], half + two.order[j]))
        for a, b in pairs_below(one, two)
        for i, j in zip(a, b, strict=True)
    }
    assert {p for p in true if min(p) < half <= max(p)} <= across
    found = links_of_block(everyone, everyone, counts, [s.view(np.int64) for s in sets], everyone)
    assert {frozenset(p) for p in found} <= true

    def labels(links):
        label = list(range(len(sets)))
        for a, b in links:
            label = [label[b] if x == label[a] else x for x in label]
        return {frozenset(k for k, x in enumerate(label) if x == y) for y in label}

    assert labels(found) == labels(map(tuple, true))


@pytest.mark.parametrize("copies", [200, 800])
def test_a_group_of_near_copies_takes_a_few_ties_each(spark, copies):
    texts = near_texts(77, 150, copies, 5)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    signed = ngram_join._rows(rows).mapInArrow(ngram_join._signed, ngram_join.POINT)
    classes = signed.withColumn("class", F.monotonically_increasing_id())
    stars = ngram_join._buckets(classes).filter("class != star").select("star", "class").distinct()
    assert stars.count() < 8 * len(texts)


# Words


def test_words_that_a_polynomial_confuses():
    """A Thue-Morse word of 1024 bytes and its complement, and other long words."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    for length in (7, 8, 9, 16, 255, 256, 257, 1024):
        texts = [word[:length], other[:length]]
        data = np.frombuffer(" ".join(texts).encode(), np.uint8)
        words = words_of(data, np.array([0, len(data)]))
        assert len(set(words.hashes().tolist())) == 2
        assert set(words.hashes().tolist()).isdisjoint(words.hashes(seed=1).tolist())


def test_word_hashes_depend_on_the_bytes_of_the_word_only():
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randrange(1, 30))) for _ in range(3000)]
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    hashes = words_of(data, np.array([0, len(data)])).hashes().tolist()
    by_word = {}
    for text, value in zip(texts, hashes, strict=True):
        assert by_word.setdefault(text, value) == value
    assert len(set(by_word.values())) == len(by_word)
    assert all(a < b for a, b in pairwise(sorted(set(hashes))))


def test_confused_words_are_told_apart_by_the_joins(spark):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(6, word), (7, other)], "doc_id BIGINT, text STRING")
    for found in (ngram_join.similar_documents(docs), queries.near_duplicates(docs)):
        assert {r.component_id for r in found.collect()} == {6, 7}
    many = [(6, " ".join([word] * 13)), (7, " ".join([other] * 13))]
    kept = queries.remove_repeated_passages(spark.createDataFrame(many, "doc_id BIGINT, text STRING"))
    assert {r.n_removed for r in kept.select("n_removed").collect()} == {0}
