"""Plain versions of what the operators return, over texts by doc_id."""

import struct
import zlib
from collections import Counter, defaultdict


def u32(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def library_ids(texts, name, end=None):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return {i: tokenizer.encode(t, add_special_tokens=False).ids + ([] if end is None else [end]) for i, t in texts.items()}


def shingles(text):
    words = text.lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def near_classes(texts, threshold=0.8):
    """Least id of each document's class: exact set similarity of all pairs that share a shingle."""
    ids = sorted(texts)
    sets, root, holders = [shingles(texts[i]) for i in ids], list(range(len(ids))), defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def link(a, b):
        a, b = sorted((find(a), find(b)))
        root[b] = a

    empty = [k for k, s in enumerate(sets) if not s]
    for k in empty[1:]:
        link(empty[0], k)
    for k, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        for j, n in shared.items():
            if n >= threshold * (len(own) + len(sets[j]) - n) - 1e-9:
                link(j, k)
        for s in own:
            holders[s].append(k)
    return {i: ids[find(k)] for k, i in enumerate(ids)}


def kept_lines(texts, least=10):
    """Lines before, lines dropped and the rest of each document."""
    blanks, lower = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    first = {}
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            first.setdefault(line.strip(blanks).translate(lower), i)
    out = {}
    for i, t in texts.items():
        lines = t.split("\n")
        keys = [line.strip(blanks).translate(lower) for line in lines]
        stay = [line for line, k in zip(lines, keys, strict=True) if len(k) < least or first[k] == i]
        out[i] = len(lines), len(lines) - len(stay), "\n".join(stay)
    return out


def packing_is_sound(rows, ids, capacity=2048):
    """Every document's ids are there once, no sequence is too long, and places leave no gap."""
    sequences = defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == r.piece * capacity and len(part) == r.length and zlib.crc32(u32(part)) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert Counter(r.doc_id for r in rows) == {i: -(-len(x) // capacity) for i, x in ids.items()}
    return len(sequences)
