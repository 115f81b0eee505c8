"""Byte-level BPE, phrase collocations and the Merkle manifest against libraries, brute force and on odd input."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortry.llm import byte_bpe, collocations, manifest, token_counts, url_filter

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("ids", "decoded", "h", "f", "words", "prefix", "place", "size", "tree", "digest", "key", "group", "part", "path", "given")
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "One two, three", "en", "b", 14),
    (4, "One two, three", "en", "b", 14), (5, "x " * 30_000 + "y" * 30_000, "de", "c", 90_000), (None, "lost row", "en", "a", 8),
    (None, "lost row", "en", "a", 8), (6, "Ünïcode’s ‘quotes’ don't 123 😀 naïve", "fr", "d", 37), (7, "solo", "und", None, 4), (14, "seven", "es", "a", 5),
    (7, "other text", "es", "a", None),
]


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in CLASH})


# --- byte-level BPE --------------------------------------------------------------------

library = tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=byte_bpe.read_ranks(), special_tokens={})
codec = byte_bpe.Codec(limit=50)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("abe ’'s\n\t 1", max_size=120), max_size=6))
def test_ids_equal_the_library(texts):
    packed = codec.encode(texts)
    assert [ids(p) for p in packed] == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(p) for p in packed] == [t.encode() for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.text("abeth ", min_size=1, max_size=90))
def test_rows_merge_like_one_tree(text):
    piece = text.encode()
    if len(piece) > 1:
        width = 1 << (len(piece) - 1).bit_length()
        assert ids(codec.vocabulary.merge_rows([piece, b"zz"], max(width, 2))[0]) == byte_bpe.merge(piece, codec.vocabulary.ranks)


def test_pairs_are_found_in_a_few_steps():
    """Every pair is in the slot its code hashes to or close behind; pairs that merge into nothing are told apart."""
    pairs = codec.vocabulary.pairs
    code = pairs.codes[pairs.codes >= 0]
    steps = (np.flatnonzero(pairs.codes >= 0) - pairs._slots(code)) & (len(pairs.codes) - 1)
    assert steps.mean() < 0.5 and steps.max() < 32 and len(np.unique(code)) == len(code)
    assert (pairs.of(code >> 32, code & 0xFFFFFFFF) == pairs.made[pairs.codes >= 0]).all()
    rng = np.random.default_rng(5)
    left, right = rng.integers(0, 50_000, (2, 20_000))
    known = dict(zip(code.tolist(), pairs.made[pairs.codes >= 0].tolist()))
    assert pairs.of(left, right).tolist() == [known.get(c, -1) for c in ((left << 32) | right).tolist()]
    assert byte_bpe.PairTable({}).of(left, right).max() == -1


def test_many_rows_merge_like_one_each():
    rng = np.random.default_rng(7)
    for width in (2, 4, 16, 64):
        pieces = [bytes(rng.choice([*b"etaonr"], rng.integers(2, width + 1)).tolist()) for _ in range(300)]
        merged = codec.vocabulary.merge_rows(pieces, width)
        assert [ids(m) for m in merged] == [byte_bpe.merge(p, codec.vocabulary.ranks) for p in pieces]


def test_long_pieces_and_segments():
    long = ["a" * 50_000, "abcdefghij" * 3_000, " " * 10_000, "word " * 40_000]
    assert [ids(p) for p in codec.encode(long)] == [library.encode_ordinary(t) for t in long]
    text = "some words  and\n\n more 12 words, " * 40
    assert [p for part in byte_bpe.segments(text, 30) for p in codec.find(part)] == codec.find(text)
    assert len(list(byte_bpe.segments(text, 30))) > 10


def test_bpe_of_odd_rows(spark):
    done = byte_bpe.decode_ids(byte_bpe.encode_texts(documents(spark, ROWS))).collect()
    expected = Counter((r[0], tuple(library.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in ROWS)
    assert Counter((r.doc_id, tuple(ids(r.ids)), bytes(r.decoded)) for r in done) == expected
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(documents(spark, []))).collect() == []
    with pytest.raises(KeyError):
        codec.decode(np.array([60_000], "<u4").tobytes())


# --- collocations ----------------------------------------------------------------------


def phrases(rows, least, top):
    count, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            count.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = []
    for (lang, p), a in count.items():
        if len(p) < 2 or a < least:
            continue
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(m == lang and len(q) > len(p) and inside(q) and 100 * f >= 80 * a for (m, q), f in count.items()):
            continue
        cuts = [(2_000_000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k, count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        found.append((lang, -score, -a, " ".join(p).encode(), left, right))
    found.sort()
    out, ranks = [], Counter()
    for lang, score, a, p, left, right in found:
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], p.decode(), -a, left, right, total[lang], -score))
    return out


def answers(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("least, top, held", [(3, 1_000, 1 << 21), (2, 5, 40)])
def test_phrases_equal_brute_force(spark, monkeypatch, least, top, held):
    rng = np.random.RandomState(3)
    words = ["the", "The", "of", "a", "cat’s", "long" * 20, "ñu", "x\x1cy", "dog"]
    rows = [
        (i, "".join(rng.choice(words, p=[0.3, 0.1, 0.2, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05]) + rng.choice([" ", "  ", ", ", "\t", "\n"], p=[0.7, 0.1, 0.1, 0.05, 0.05])
         for _ in range(rng.randint(1, 60))), str(rng.choice(["en", "de"])) if i % 5 else None, None, None)
        for i in range(60)
    ] + ROWS[:5] + ROWS[6:]
    monkeypatch.setattr(collocations, "HELD", held)
    assert answers(collocations.collocations(documents(spark, rows), least, top)) == sorted(phrases(rows, least, top))


def test_words_across_chunks(monkeypatch):
    blob = ("The old, old house. " + "word" * 30 + "\n\nñandú’s\tend; ").encode() * 9
    whole = collocations.Words(blob, "en", 0)
    monkeypatch.setattr(collocations, "CHUNK", 7)
    parts = collocations.Words(blob, "en", 0)
    assert (parts.hashes != 0).sum() == 9 * 7 and parts.hashes[parts.hashes != 0].tolist() == whole.hashes[whole.hashes != 0].tolist()
    places = np.flatnonzero(parts.hashes != 0)
    assert parts.spelled(places)[:7] == ["the", "old", "old", "house", "word" * 30, "ñandú’s", "end"]
    runs = lambda w: [len(r) for r in " ".join("." if x == 0 else "w" for x in w.hashes).replace(" ", "").split(".") if r]
    assert runs(parts) == runs(whole)


def test_phrases_of_very_long_and_empty_tables(spark):
    long = [(1, "a b " * 20_000 + "word" * 20_000 + " end", "en", None, None)] * 2
    assert answers(collocations.collocations(documents(spark, long))) == sorted(phrases(long, 30, 2_000))
    assert answers(collocations.collocations(documents(spark, []))) == []
    assert answers(collocations.collocations(documents(spark, ROWS[:4]))) == []


def test_words_that_share_a_hash_are_counted_again(spark, monkeypatch):
    """Under the first seed all words share a hash, which must show and be mended."""
    rows = [(i, "one two three", "en", None, None) for i in range(40)]
    docs, counted = documents(spark, rows), collocations.count_words

    def colliding(texts, seed):
        found = counted(texts, seed)
        if seed == 0:
            found = found.groupBy(F.lit(1).cast("bigint").alias("h")).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("f").alias("f"))
        return found

    monkeypatch.setattr(collocations, "count_words", colliding)
    assert answers(collocations.collocations(docs)) == sorted(phrases(rows, 30, 2_000))


def test_filter_lets_all_members_pass(spark):
    members = np.random.RandomState(1).randint(-(2**62), 2**62, 5_000)
    made = collocations.bloom_filter(spark.createDataFrame([(int(x),) for x in members], "h bigint"))
    assert made.has(members).all()
    assert made.has(members + 1).mean() < 0.02
    assert not collocations.bloom_filter(spark.createDataFrame([], "h bigint")).has(members).any()


# --- manifest --------------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(level):
    """Root, and per leaf the siblings as (left, right)."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            path.append((level[i - 1], "") if i % 2 else ("", level[i + 1] if i + 1 < len(level) else ""))
        level, at = [h(*level[i : i + 2]) for i in range(0, len(level), 2)], [i // 2 for i in at]
    return level[0], paths


def expected_manifest(rows):
    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    langs = sorted({r[2] for r in rows}, key=order)
    trees = [sorted((r for r in rows if r[2] == lang), key=lambda r: (order(r[0]), leaf(*r))) for lang in langs]
    built = [climb([leaf(*r) for r in tree]) for tree in trees]
    root, upper = climb([b[0] for b in built])
    out = []
    for tree, (subroot, paths), above in zip(trees, built, upper):
        for row, path in zip(tree, paths):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None
            folded = leaf(*row[:4], row[4] + changed if row[4] is not None else None)
            for left, right in path + above:
                folded = h(left, folded, right)
            out.append((str(row[0]), leaf(*row), subroot, root, h(*(x for pair in path + above for x in pair)), folded, folded == root))
    return sorted(out)


def manifested(df):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


def test_manifest_of_odd_rows(spark):
    got = manifested(manifest.tampered_manifest(documents(spark, ROWS)))
    assert got == expected_manifest(ROWS)
    assert {r[-1] for r in got} == {True, False}
    assert manifested(manifest.tampered_manifest(documents(spark, []))) == []
    assert manifested(manifest.tampered_manifest(documents(spark, ROWS[:1]))) == expected_manifest(ROWS[:1])


def test_manifest_in_tiers_and_partitions(spark, monkeypatch):
    """Trees of several tiers, and leaf partitions that are not aligned with them."""
    rows = [(i, f"text {i}", None if i % 10 == 0 else "en" if i % 3 else f"l{i % 7}", "s", i) for i in range(700)]
    monkeypatch.setattr(manifest.build_nodes, "__defaults__", (2,))
    monkeypatch.setattr(manifest.prove, "__defaults__", (13,))
    assert manifested(manifest.tampered_manifest(documents(spark, rows))) == expected_manifest(rows)


def test_some_leaves_prove_alone(spark):
    docs = documents(spark, [(i, f"t{i}", "en", "s", i) for i in range(100)])
    leaves, nodes = manifest.manifest(docs)
    some = manifest.prove(leaves.where("key % 9 = 0"), nodes, 40)
    assert some.where(manifest.fold_path(F.col("digest"), F.col("path")) != F.col("root")).count() == 0
    assert some.count() == 12


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 80), st.sets(st.integers(0, 79), min_size=1))
def test_octopus_is_least_and_enough(size, chosen):
    chosen = {c % size for c in chosen}
    level = [h(str(i)) for i in range(size)]
    every, at, n = {(0, i): d for i, d in enumerate(level)}, 0, size
    while n > 1:
        n = (n + 1) // 2
        at += 1
        every |= {(at, i): manifest.digest(*[every[at - 1, j] for j in (2 * i, 2 * i + 1) if (at - 1, j) in every]) for i in range(n)}
    proof = manifest.octopus(chosen, size)
    known = {c: every[c] for c in proof} | {(0, i): level[i] for i in chosen}
    derivable = dict(known)
    manifest.derive(derivable, chosen, size)
    assert derivable == {c: every[c] for c in derivable} and derivable[max(derivable)] == every[at, 0]
    assert not {c for c in proof if c[0] and any((c[0] - 1, 2 * c[1] + k) in derivable for k in (0, 1))}
    for i in chosen:
        assert manifest.fold(level[i], manifest.siblings(derivable, i, size)) == every[at, 0]


# --- mended operators ------------------------------------------------------------------


def test_keys_of_long_hosts_are_bounded_by_the_rules():
    host = "a." * 8_000 + "example.org"
    keys = url_filter.keys_of(host, "/es/1", [1, 4], 11)
    assert keys == ["example.org/es/", "example.org/", "org/es/", "org/"]
    assert url_filter.keys_of("", "", [1], 11) == [] and url_filter.keys_of("org", "/", [1], 11) == ["org/"]


def test_rollup_returns_to_a_fresh_count(spark):
    """Shares deleted, revised, compacted and put back: the totals of the whole table, from few folders."""
    docs = documents(spark, [(i, f"some words {i} " * (i % 7), ["en", None, "de"][i % 3], "s", None) for i in range(200)])
    fresh = token_counts.count_tokens(docs).groupBy("source", "lang", "tokenizer").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    got = token_counts.documents_rollup(docs)
    rows = lambda df: sorted(str(tuple(r[c] for c in ("source", "lang", "tokenizer", "n_docs", "n_tokens"))) for r in df.collect())
    assert rows(got) == rows(fresh) and len(got.inputFiles()) >= 1
