import zlib

import numpy as np
import pytest

from ripplebook.llm import packing
from tests.llm.util import awkward, empty, prose

PATHS = packing.tokenizer_paths()


@pytest.mark.parametrize("seed", range(8))
def test_blocks_are_dense_and_gapless(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 800))
    lengths = np.clip(rng.lognormal(6, 1, n).astype(int), 1, 2048)
    bins, offsets = packing.pack_lengths(lengths, 2048)
    for b in np.unique(bins):
        at = 0
        for i in sorted(np.flatnonzero(bins == b), key=lambda i: offsets[i]):
            assert offsets[i] == at
            at += lengths[i]
        assert at <= 2048 and (3 * lengths[bins == b] > 2048).sum() <= 2
    big = lengths[3 * lengths > 2048]
    least = max(-(-lengths.sum() // 2048), -(-len(big) // 2))
    assert len(np.unique(bins)) <= 1.25 * least + 2


def test_pieces_of_awkward_rows(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATHS[0])
    tok.encode_special_tokens = True
    df = awkward(spark, [(20, "<|endoftext|> 日本語 \u0085 x"), (21, "a" * 3), (22, "word " * 2047)])
    rows = packing.pack(df, block_rows=4).collect()
    texts = [(r.doc_id, r.text or "") for r in df.collect()]
    assert sum(r.piece == 0 for r in rows) == len(texts)
    want = []
    for doc_id, text in texts:
        ids = tok.encode(text, add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 if len(ids) > 2048 else len(ids)
        cuts = [0, *range(first or 2048, len(ids), 2048), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(empty(spark)).count() == 0


def test_rendered_sequences_are_the_tokens(spark):
    df = spark.createDataFrame([(i, "some words " * (40 * i)) for i in range(30)], "doc_id bigint, text string")
    packed = packing.pack(df)
    seqs = {r.sequence_id: r.ids for r in packing.render(df, packed).collect()}
    for r in packed.collect():
        part = seqs[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    assert sum(map(len, seqs.values())) == sum(r.length for r in packed.collect())


def test_both_encoders_agree():
    slow, fast = packing._encoders(*PATHS)
    for c in [*range(0x7F), *range(0xA1, 0x17F), *range(0x2010, 0x2028), 0x20AC]:
        for form in ("a{}b", "a {} b", " {}{} ", "1{}2", "{}'s\n{}"):
            text = form.replace("{}", chr(c))
            assert fast.encode_ordinary(text) == slow.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_partitions_give_the_same_sequences(spark):
    texts = [(k, prose(k, 20 + 37 * k % 900)) for k in range(200)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    packed = lambda n: sorted(map(str, packing.pack(df.repartition(n), block_rows=64).collect()))
    assert packed(1) == packed(5)


def test_a_row_repeated_over_and_over_fills_no_block(spark):
    df = spark.createDataFrame([(1, "one and the same")] * 500 + [(k, prose(k, 30)) for k in range(2, 100)], "doc_id bigint, text string")
    rows = packing.pack(df, block_rows=50).collect()
    sizes = {}
    for r in rows:
        sizes[r.sequence_id >> 32] = sizes.get(r.sequence_id >> 32, 0) + 1
    assert len(rows) == 598 and max(sizes.values()) < 120
