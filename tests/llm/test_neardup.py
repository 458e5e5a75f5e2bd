import random
import re

from conftest import ODD  # noqa: F401  (tests/llm/conftest)
from gristmill.llm import neardup


def sets_of(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    ids = sorted({i for i, _ in rows})
    texts = {i: sets_of(t, k) for i, t in rows}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = texts[a], texts[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(texts[i]), find(i)) for i in ids}


def made(seed, families=6, size=14, words=60):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(families):
        base = [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(words)] = str(rng.random())
            rows.append((n, " ".join(w)))
            n += 1
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(documents):
    for k, s in ((3, 0.85), (5, 0.8)):
        rows = made(k)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(documents(rows), k, s).collect()}
        assert got == brute(rows, k, round(100 * s))


def test_large_groups_meet_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(neardup, "GROUP", 5)
    monkeypatch.setattr(neardup, "BLOCK", 300)
    rows = made(9, families=2, size=25)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(documents(rows), 3, 0.85).collect()}
    assert got == brute(rows, 3, 85)


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (5, "one"), (None, "one"), (7, "wörd " * 4000), (8, "x" * 60000)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.components(documents(rows), 3, 0.85).collect()), key=str)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False), (None, 1, None, True), (7, 1, 7, True), (8, 1, 8, True)]
    assert got == sorted(want, key=str)


def test_empty_and_dedup(documents):
    assert neardup.components(documents([])).count() == 0
    df = documents([(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "q r s t u v w")])
    out = neardup.deduped(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 2]


def test_threshold():
    assert 0 < neardup.threshold(0.8) < neardup.threshold(0.9) <= neardup.COORDS


def test_deduped_keeps_one_row_of_each_group(documents):
    same, other, clean, empty = (" ".join(f"{x}{i}" for i in range(40)) for x in "abce")
    rows = [(1, same), (1, same), (2, other), (3, other), (3, clean), (None, empty), (None, empty), (None, same), (None, ""), (None, "")]
    got = [(r.doc_id, r.text) for r in neardup.deduped(documents(rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, same), (2, other), (3, clean), (None, empty), (None, ""), (None, "")], key=str)
