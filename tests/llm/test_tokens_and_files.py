import hashlib
import io
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from logloom.llm import merge_dropout, packing, progressive_jpeg, queries, token_cache, zstd_frames
from logloom.llm.common import scratch

from .brute import library_ids, packing_is_sound, u32
from .conftest import SF


def test_media_hold_the_payload(spark, own, none, texts):
    got = {r.doc_id: r for r in progressive_jpeg.media_features(own).collect()}
    assert set(got) == set(texts) and progressive_jpeg.media_features(none).count() == 0
    for i, t in texts.items():
        raw = t.encode()
        padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    assert got[1][1:] == got[2][1:] and got[4][1:] == got[5][1:]


def test_files_hold_all_ids_in_order(own, none, texts):
    ids, start = library_ids(texts, "word_bpe_49k.json", 2), 0
    got = {r.doc_id: r for r in zstd_frames.token_files(own).collect()}
    assert zstd_frames.token_files(none).count() == 0
    for i in sorted(texts):
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[i]), zlib.crc32(u32(ids[i])))
        start += len(ids[i])


def test_frames_are_read_alone_and_checked(spark, own, texts):
    data = zstd_frames.encode_buffer([(3, b"abc" * 50), (5, b""), (9, b"xyz" * 70)])
    reader = zstd_frames.SeekableReader(io.BytesIO(data), len(data))
    assert reader.document(9) == [b"xyz" * 70] and reader.document(4) == [] and [x for _, x in reader.frames()] == [b"abc" * 50, b"", b"xyz" * 70]
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as plain:
        assert plain.read() == b"abc" * 50 + b"xyz" * 70
    broken = bytearray(data)
    broken[len(data) - 9 - 12 + 8] ^= 1  # the last frame's checksum
    with pytest.raises(ValueError):
        zstd_frames.SeekableReader(io.BytesIO(bytes(broken)), len(data)).frame(2)
    manifest = zstd_frames.write_frames(own, scratch(spark, "files"), "word_bpe_49k.json", 2)
    wanted = spark.createDataFrame([(9,), (1,), (99,)], "doc_id long")
    ids = library_ids(texts, "word_bpe_49k.json", 2)
    assert {r.doc_id: list(r.ids) for r in zstd_frames.lookup(manifest, wanted).collect()} == {i: ids[i] for i in (1, 9)}


def test_counts_are_the_library_s_and_misses_alone_are_encoded(spark, own, none, texts):
    cache = scratch(spark, "cache")
    ids = library_ids(texts, "byte_bpe_50k.json")
    for _ in range(2):  # the second time from the cache
        got = {r.doc_id: r for r in token_cache.count_tokens(own, cache=cache).collect()}
        assert {i: (r.n_bytes, r.n_tokens, r.over_limit) for i, r in got.items()} == {i: (len(t.encode()), len(ids[i]), len(ids[i]) > 1024) for i, t in texts.items()}
    path = f"{cache}/version={token_cache.tokenizer_version('byte_bpe_50k.json')}"
    assert spark.read.parquet(path).count() == len({t for t in texts.values()})
    assert token_cache.count_tokens(none).count() == 0


def test_all_documents_have_the_library_s_counts(spark, all_texts):
    got = {r.doc_id: r.n_tokens for r in queries.op5_token_cache(spark, SF).collect()}
    assert got == {i: len(x) for i, x in library_ids(all_texts, "byte_bpe_50k.json").items()}


def test_dropout_varies_and_decodes(spark, own, none, texts):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    pieces = merge_dropout.pieces("piece_bpe_32k.model")
    for rate in (0.0, 0.1, 1.0):
        rows = merge_dropout.encode_column(own, rate=rate).collect()
        assert {r.doc_id: merge_dropout.decode(pieces, r.ids).decode() for r in rows} == texts
        if not rate:
            assert all(bytes(r.ids) == u32(sp.encode(texts[r.doc_id])) for r in rows if "▁" not in texts[r.doc_id])
    plain, cut = ({r.doc_id: r.n_pieces for r in merge_dropout.encode_and_decode(own, rate=x).collect()} for x in (0.0, 0.1))
    assert cut[1] > plain[1] and cut[7] > plain[7]
    seeds = [{r.doc_id: r.ids_crc32 for r in merge_dropout.encode_and_decode(own, seed=s).collect()} for s in (1, 1, 2)]
    assert seeds[0] == seeds[1] != seeds[2]
    assert merge_dropout.encode_and_decode(none).count() == 0


def test_every_occurrence_and_every_copy_is_cut_by_itself(spark):
    text = " ".join(["wonderful straightforwardness"] * 200)
    docs = spark.createDataFrame([(i, text) for i in range(40)] + [(0, text)], "doc_id long, text string")
    rows = [(r.doc_id, bytes(r.ids)) for r in merge_dropout.encode_column(docs).collect()]
    copies = dict(rows)
    assert len(set(copies.values())) == 40 and [x for i, x in rows if i == 0] == [copies[0]] * 2
    pieces = merge_dropout.pieces("piece_bpe_32k.model")
    state = merge_dropout.Dropout(pieces, seed=1, rate=0.1)
    ways = {state.encode(["x wonderful"], [v])[0] for v in range(60)}
    assert len(ways) > 4
    one = merge_dropout.Dropout(pieces, seed=1, rate=0.5).encode([text], [7])[0]
    words = Counter(b"".join(pieces.raw[i] + b"|" for i in struct.unpack(f"<{len(one) // 4}I", one)).split(b" ")[1:])
    assert len(words) > 20


def test_the_memo_of_merges_gives_what_the_agenda_gives():
    pieces = merge_dropout.pieces("piece_bpe_32k.model")
    text = "The wonderful boats, and 1984 na\u00efve caf\u00e9s \U0001f642 went  home: straightforwardness! " * 30 + "x" * 90
    for rate in (0.1, 0.4):
        state = merge_dropout.Dropout(pieces, seed=3, rate=rate)
        alone = merge_dropout.Dropout(pieces, seed=3, rate=rate)
        alone._occurrences = lambda part, key, s=alone: _agendas(s, part, key)
        assert state.encode([text, "", text], [5, 6, -8]) == alone.encode([text, "", text], [5, 6, -8])


def _agendas(state, part, key):
    rows = [state.pieces.finish(state.agenda(state.pieces.matrix([state.chunks[c]])[0].tolist(), int(k))) for c, k in zip(part, key, strict=True)]
    return np.frombuffer(b"".join(rows), "<u4"), np.array([len(r) // 4 for r in rows])


def test_one_and_many_agendas_agree():
    pieces = merge_dropout.pieces("piece_bpe_32k.model")
    state = merge_dropout.Dropout(pieces, seed=3, rate=0.3)
    for part in (" wonderful", " straightforwardness", " ab", " x"):
        sym = pieces.matrix([part])
        key = state.part_keys(sym, 1)
        row = state.side_by_side(sym, key)[0]
        assert row[row >= 0].tolist() == state.agenda(sym[0].tolist(), int(key[0]))


def test_packing_of_edge_cases(own, none, texts):
    ids = library_ids(texts, "word_bpe_49k.json", 0)
    rows = packing.pack_documents(own).collect()
    assert packing_is_sound(rows, ids) == -(-sum(map(len, ids.values())) // 2048)
    assert packing.pack_documents(none).count() == 0
    pieces = packing.token_pieces(own, "word_bpe_49k.json", 0, 2048)
    assert packing_is_sound(packing.pack_pieces(pieces, 2048, group_pieces=4).collect(), ids)  # several groups and levels


def test_packing_of_all_documents_needs_few_sequences(spark, all_texts):
    ids = library_ids(all_texts, "word_bpe_49k.json", 0)
    assert packing_is_sound(queries.op7_swap_packing(spark, SF).collect(), ids) <= 1.01 * sum(map(len, ids.values())) / 2048


def test_exchanges_save_bins():
    lengths = sorted([60, 60, 60, 50, 50, 40, 40, 40, 30, 30, 20, 20], reverse=True)
    bins = packing._Exchange(packing.best_fit(lengths, 100), lengths, 100).run()
    assert sorted(k for b in bins for k in b) == list(range(len(lengths))) and len(bins) == 5 and all(sum(lengths[k] for k in b) <= 100 for b in bins)


def test_repeated_and_null_ids_give_a_row_each(spark):
    """Rows that repeat a doc_id, with the same text or another, and rows without one are all there once, with their own values."""
    rows = [(1, "one two three"), (1, "one two three"), (1, "another text altogether"), (None, "no id"), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = {t: library_ids({0: t or ""}, "word_bpe_49k.json")[0] for _, t in rows}
    sums = lambda end: sorted(((i or -1), zlib.crc32(u32(ids[t] + [end]))) for i, t in rows)
    files = zstd_frames.token_files(docs).collect()
    assert sorted(((r.doc_id or -1), r.ids_crc32) for r in files) == sums(2)
    ordered = sorted((r.start, r.n_tokens) for r in files)
    assert [s for s, _ in ordered] == [sum(n for _, n in ordered[:k]) for k in range(len(ordered))]
    packed = packing.pack_documents(docs).collect()
    assert sorted(((r.doc_id or -1), r.ids_crc32) for r in packed) == sums(0) and len({(r.sequence_id, r.offset) for r in packed}) == len(rows)
    counts = library_ids({k: t or "" for k, (_, t) in enumerate(rows)}, "byte_bpe_50k.json")
    assert sorted(((r.doc_id or -1), r.n_tokens) for r in token_cache.count_tokens(docs).collect()) == sorted(((i or -1), len(counts[k])) for k, (i, _) in enumerate(rows))
    media = sorted(((r.doc_id or -1), r.n_bytes) for r in progressive_jpeg.media_features(docs).collect())
    decoded = sorted(((r.doc_id or -1), r.n_bytes) for r in merge_dropout.encode_and_decode(docs).collect())
    assert media == decoded == sorted(((i or -1), len((t or "").encode())) for i, t in rows)
