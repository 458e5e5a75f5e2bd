import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gristmill.llm import packing

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got, window=packing.WINDOW):
    t = Tokenizer.from_file(VOCAB)
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for i, x in rows}
    copies = {i: sum(1 for j, _ in rows if j == i) for i, _ in rows}
    have = {i: 0 for i in ids}
    for r in got:
        a = ids[r.doc_id]
        assert r.doc_tokens == len(a) and r.ids_crc32 == zlib.crc32(a[r.start : r.start + r.length].tobytes())
        have[r.doc_id] += r.length
    assert all(have[i] == len(ids[i]) * copies[i] for i in ids)
    waste = 0
    for _, part in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in part:
            assert r.offset == at
            at += r.length
        assert at <= window
        waste += 0 if at & (at - 1) == 0 else window - at
    assert waste == 0


def test_every_id_once_and_no_padding(documents):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma-delta", "don't", "ünïcode", "<|endoftext|>", "1234", "\x1cx y"]) for _ in range(rng.choice([0, 3, 50, 400, 3000])))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "dup"), (102, "dup"), (None, "null id")]
    check(rows, packing.packed(documents(rows), VOCAB).collect())


def test_one_length_only(documents):
    rows = [(i, "a " * 2999) for i in range(7)]
    check(rows, packing.packed(documents(rows), VOCAB).collect())
    assert packing.packed(documents([]), VOCAB).count() == 0


def test_more_cells_where_a_length_has_many_pieces(documents, monkeypatch):
    monkeypatch.setattr(packing, "SALTS", 2)
    monkeypatch.setattr(packing, "CELL", 3)
    rows = [(i, "a " * 40) for i in range(50)] + [(100 + i, "a " * i) for i in range(20)]
    check(rows, packing.packed(documents(rows), VOCAB).collect())


def test_repeated_rows_are_encoded_once_more_each(documents):
    rows = [(1, "a " * 2999)] * 30 + [(2, "b " * 2999)] * 3 + [(1, "b c " * 2000)]
    got = packing.packed(documents(rows), VOCAB).collect()
    assert sum(r.length for r in got) == 33 * 3000 + 4001
    t = Tokenizer.from_file(VOCAB)
    for i, x in set(rows):
        a = np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4")
        own = [r for r in got if r.doc_id == i and r.doc_tokens == len(a)]
        assert sum(r.length for r in own) == len(a) * rows.count((i, x))
        assert all(r.ids_crc32 == zlib.crc32(a[r.start : r.start + r.length].tobytes()) for r in own)


def test_fill_is_the_closest_subset_sum():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(1, 5))}
        room = rng.randrange(1, 90)
        best = max(s for pick in itertools.product(*(range(c + 1) for c in counts.values())) if (s := sum(n * p for n, p in zip(counts, pick, strict=True))) <= room)
        got, used = packing.fill(counts, room)
        assert got == best == sum(n * u for n, u in used.items()) and all(u <= counts[n] for n, u in used.items())
