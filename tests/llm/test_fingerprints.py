import hashlib
import random

import numpy as np
import pyarrow as pa

from gristmill.llm import fingerprints as fp


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))


def test_rows_follow_the_contract(documents):
    rng = random.Random(2)
    rows = [(i * 3, words(rng, rng.randrange(0, 200))) for i in range(300)] + [(2000, None), (2001, "é𝄞" * 9), (2002, rng.choice("ab") * 5000)]
    order = sorted(rows)
    rng.shuffle(rows)
    got = {r.doc_id: r for r in fp.fingerprints(documents(rows)).collect()}
    assert len(got) == len(rows)
    for n, (i, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        q = len(text) // 4
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256((text[: len(text) - q] + after[:q]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    long = [r for r in got.values() if r.n_chars > 200 and r.doc_id < 2000]
    assert np.mean([r.near_edited for r in long]) > 0.45 > 0.1 > np.mean([r.near_next for r in long])


def test_context_does_not_matter():
    rng = random.Random(3)
    texts = [words(rng, 120) for _ in range(40)] + ["", "a", "aa", "aaa", "ab" * 50]
    alone = [fp._printed(*fp.sketches(pa.array([t])))[0] for t in texts]
    assert fp._printed(*fp.sketches(pa.array(texts))) == alone
    assert len(set(alone)) == len(texts)


def test_equal_substrings_share_inner_names():
    rng = random.Random(5)
    shared = words(rng, 400)
    a, b = fp.sketches(pa.array(["x" * 7 + shared, words(rng, 11) + shared]))[1]
    assert fp.likeness(a[None], b[None], np.array([False]))[0] > 0.8


def test_labels_differ_from_their_neighbours():
    names = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    label = fp._toss(names, np.array([0, 100, 4000]))
    same = label[1:] == label[:-1]
    same[[99, 3999]] = False
    assert not same.any() and label.max() < 6


def test_lone_empty_and_repeated(documents):
    r = fp.fingerprints(documents([(1, "some words of a text")])).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    assert fp.fingerprints(documents([])).count() == 0
    got = fp.fingerprints(documents([(1, "same text here"), (1, "same text here"), (None, "")])).collect()
    assert len(got) == 3 and len({r.fingerprint for r in got}) == 2


M = (1 << 64) - 1


def scrambled(h):
    for _ in range(2):
        h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & M
    return h ^ (h >> 32)


def tossed(names):
    """Coin tossing, one symbol at a time."""
    low = lambda x: (x & -x).bit_length() - 1
    out = []
    for i, a in enumerate(names):
        k = low(a ^ names[i - 1]) if i else 0
        out.append(2 * k + (a >> k & 1))
    for _ in range(3):
        out = [2 * (k := low(a ^ out[i - 1]) if i else 0) + (a >> k & 1) for i, a in enumerate(out)]
    return out


def parsed(text):
    """Root and the sorted smallest names of a text, by the definition."""
    p, names, level, found = int(fp._P), [b + 1 for b in text.encode()], 0, set()
    while names:
        if level and len(names) > 1:
            found |= {scrambled((n + level) & M) >> 32 for n in names}
        if len(names) == 1:
            break
        joined = []
        for n in names:
            if joined and joined[-1][0] == n:
                joined[-1][1] += 1
            else:
                joined.append([n, 1])
        names = [scrambled(n ^ (c * p & M)) if c > 1 else n for n, c in joined]
        label = tossed(names)
        cuts = [i for i in range(len(names)) if i == 0 or (i < len(names) - 1 and label[i - 1] < label[i] > label[i + 1])] + [len(names)]
        phrases = [names[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        names = [scrambled((sum(n * pow(p, i, 1 << 64) for i, n in enumerate(ph)) + len(ph)) & M) if len(ph) > 1 else ph[0] for ph in phrases]
        level += 1
    if not names:
        return 0, []
    found.add(scrambled(names[0]) >> 32)
    return scrambled(names[0]), sorted(found - {0xFFFFFFFF})[: fp.SIZE]


def test_equals_a_plain_parser():
    rng = random.Random(8)
    texts = ["", "a", "aaaa", "abab" * 30, "é𝄞 words", *(words(rng, n) for n in (1, 5, 30, 400, 3000)), ("ab " * 7 + "c ") * 900]
    roots, sketch, sizes = fp.sketches(pa.array(texts))
    for i, t in enumerate(texts):
        root, names = parsed(t)
        assert int(roots[i]) == root and sketch[i][: sizes[i]].tolist() == names
    for i in range(len(texts)):
        for j in range(len(texts)):
            a, b = (set(sketch[k][: sizes[k]].tolist()) for k in (i, j))
            both = sorted(a | b)[: fp.SIZE]
            want = 1.0 if roots[i] == roots[j] else sum(x in a and x in b for x in both) / max(len(both), 1)
            assert fp.likeness(sketch[i][None], sketch[j][None], roots[[i]] == roots[[j]])[0] == want


def test_one_rule_for_all_lengths():
    """Likeness of a text and itself with a new last quarter doesn't jump with the length."""
    rng = random.Random(9)
    means = []
    for n in (8, 16, 32, 64, 128, 256):
        both = []
        for _ in range(60):
            a, b = words(rng, n), words(rng, n)
            q = len(a) // 4
            both += [a, a[: len(a) - q] + b[:q]]
        _, s, _ = fp.sketches(pa.array(both))
        means.append(fp.likeness(s[::2], s[1::2], np.zeros(60, bool)).mean())
    assert min(means) > 0.4 and max(means) - min(means) < 0.2
