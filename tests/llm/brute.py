"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

from tokenizers import Tokenizer

from cohortry.llm.tokens import VOCABULARY

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_components(texts):
    """doc_id -> (set size, smallest reachable doc_id) by comparing every pair."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b]) if sets[a] and sets[b] else 0
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def word_total(text):
    return len(_WORD.findall(text or ""))


def mix_targets(sizes, weights=(5, 2, 1)):
    """Source -> target by resharing the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        shares = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / shares for s in order}
        above = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def draw(seed, doc_id):
    return int(hashlib.md5(f"{seed}:{doc_id}".encode()).hexdigest()[:13], 16) / 2**52


def mix_copies(rows, seeds=16):
    """Copies per row for rows (doc_id, source, text)."""
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + word_total(text)
    target, best = mix_targets(sizes), {}
    for s in sizes:
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        whole, part = int(rate), rate - int(rate)
        mine = [(i, word_total(t)) for i, source, t in rows if source == s]
        missed = [abs(whole * sizes[s] + sum(n for i, n in mine if draw(k, i) < part) - target[s]) for k in range(seeds)]
        best[s] = (whole, part, missed.index(min(missed)))
    return [best[s][0] + (draw(best[s][2], i) < best[s][1]) for i, s, _ in rows]


_tokenizer = Tokenizer.from_file(VOCABULARY)


def token_ids(text):
    return _tokenizer.encode(text or "", add_special_tokens=False).ids


def cut(text, capacity=2048):
    """(piece, start, length, crc32) of a document."""
    ids = token_ids(text) + [0]
    out = []
    for k, at in enumerate(range(0, len(ids), capacity)):
        part = ids[at : at + capacity]
        out.append((k, at, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
    return out
