"""Mixing, collocations and spelling variants against brute force, on odd rows too."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from timeloom.llm import collocations, mixing, spelling

SCHEMA = "doc_id long, text string, lang string, source string, size int, word string, n string, rank int, copies int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y", 1, 2) for r in rows], SCHEMA).repartition(5)


def odd_rows():
    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "gamma", "delta", "gamme", "gammas", "alpja", "lpha", "ÀÉé", "naïve", "naive", "xx", "of", "the", "Of"]
    weights = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(60):
        text = "".join(w + str(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"])) for w in rng.choice(words, int(rng.integers(0, 120)), p=weights / weights.sum()))
        rows.append((i, text, [None, "en", "de"][i % 3], [None, "a", "b", "é", "", "z"][min(i % 9, 5)]))
    rows += [(60, None, "en", "a"), (61, "", None, "zero"), (None, "alpha beta gamma " * 20, "en", "a"), (5, "alpha beta", "en", "b"), (5, "alpha beta", "en", "b"), (5, "alpha beta", "en", "b")]
    rows += [(70, "the of alpha naïve " * 20_000 + "x" * 50_000, "fr", "long")]
    rows += [(100 + i, "same words again and again", "en", "hot") for i in range(80)]
    return rows


def mixed_by_hand(rows, weights=(5, 2, 1), most=3):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    names = sorted({r[3] for r in rows if r[3] is not None}) + ([None] if any(r[3] is None for r in rows) else [])
    total = {s: sum(k for k, r in zip(size, rows, strict=True) if r[3] == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, whole = {}, Fraction(sum(total.values()))
    while True:
        left = [s for s in names if s not in target]
        level = (whole - sum(target.values())) / (sum(weight[s] for s in left) or 1)
        above = [s for s in left if weight[s] * level > most * total[s]]
        if not above:
            break
        target |= {s: Fraction(most * total[s]) for s in above}
    target |= {s: weight[s] * level for s in left}
    taken = Counter()
    for s in names:
        mine = sorted(((-k, r[0] is None, r[0] or 0, i) for i, (k, r) in enumerate(zip(size, rows, strict=True)) if r[3] == s))
        each = target[s] / total[s] if total[s] else Fraction(0)
        offset = Fraction(int(hashlib.md5(("mix" if s is None else f"mix:{s}").encode()).hexdigest()[:4], 16), 65536)
        for at, (k, _, _, i) in enumerate(mine):
            copies = (offset + (at + 1) * each) // 1 - (offset + at * each) // 1
            taken[rows[i][0], size[i], total[s], float(target[s]), int(copies) * size[i]] += 1
    return taken, target, total


def test_mixing(spark):
    rows = odd_rows()
    got = mixing.mix_counts(table(spark, rows)).collect()
    want, target, total = mixed_by_hand(rows)
    assert Counter((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == want
    for s in total:
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - target[s]) <= max(r.size for r in mine)
        assert all(r.taken <= 3 * r.size for r in mine)
    again = mixing.mix_counts(table(spark, rows[::-1])).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_itself(spark):
    rows = odd_rows()
    made = mixing.mix_documents(table(spark, rows)).collect()
    size = Counter()
    for r in made:
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = Counter()
    for r in mixing.mix_counts(table(spark, rows)).collect():
        want[r.source] += r.taken
    assert +size == +want


def test_mixing_of_one_source_and_of_none(spark):
    one = table(spark, [(i, "a b c", "en", "only") for i in range(10)])
    assert [r.taken for r in mixing.mix_counts(one).collect()] == [3] * 10
    assert mixing.mix_counts(one.limit(0)).collect() == []
    wordless = table(spark, [(1, None, None, None), (2, " ", "en", "a")])
    assert {(r.doc_id, r.target, r.taken) for r in mixing.mix_counts(wordless).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def phrases_by_hand(rows, longest, least, top, percent):
    count = defaultdict(Counter)
    for _, text, lang, _ in rows:
        low = (text or "").encode().lower().decode()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                count[lang or "und"].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    rows = []
    for lang, c in count.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        often = {k: v for k, v in c.items() if len(k) > 1 and v >= least}
        longer = Counter()
        for k, v in often.items():
            for m in range(2, len(k)):
                for i in range(len(k) - m + 1):
                    longer[k[i : i + m]] = max(longer[k[i : i + m]], v)
        made = []
        for k, a in often.items():
            if 100 * longer[k] >= percent * a:
                continue
            score, _, left, right = min((1000000 * a * a // (c[k[:i]] * c[k[i:]]), i, c[k[:i]], c[k[i:]]) for i in range(1, len(k)))
            made.append((-score, -a, " ".join(k).encode(), left, right))
        rows += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(made)[:top])]
    return sorted(rows)


@pytest.mark.parametrize("longest,least,top,percent", [(3, 10, 2000, 50), (4, 2, 15, 80), (2, 1, 2000, 50)])
def test_collocations(spark, longest, least, top, percent):
    rows = odd_rows()
    got = collocations.collocations(table(spark, rows), longest, least, top, percent).collect()
    assert sorted(map(tuple, got)) == phrases_by_hand(rows, longest, least, top, percent)


def test_collocations_in_small_lots_and_with_dealt_pivots(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LOT", 40)
    monkeypatch.setattr(collocations, "ROW", 3)
    rows = odd_rows()
    got = collocations.collocations(table(spark, rows), 3, 2, 500, 50).collect()
    assert sorted(map(tuple, got)) == phrases_by_hand(rows, 3, 2, 500, 50)


def test_slices_of_long_texts_keep_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 10)
    for raw in (b"ab cd\nef gh ij kl mn\nop", b"no mark in all of this text", b"", b"\n" * 30, b"a\nb\nc\nd\ne\nf\ng\nh\ni"):
        assert b"\n".join(collocations._sliced(raw)) == raw


def test_no_phrases(spark):
    none = table(spark, [(1, None, "en", "a"), (2, "", None, "a"), (3, "one, two; three", "de", "b")])
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(none.limit(0)).collect() == []


def variants_by_hand(rows, least=5, seldom=3, divisor=97, times=2):
    count = Counter()
    for key, text, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (text or "").encode().lower().decode()):
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % divisor == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                count[w] += 1
    n = {w: k for w, k in count.items() if k >= seldom}

    def one_edit(x, y):
        if len(x) > len(y):
            x, y = y, x
        if len(y) - len(x) > 1 or x == y:
            return False
        if len(x) == len(y):
            return sum(p != q for p, q in zip(x, y, strict=True)) == 1
        return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    near = defaultdict(set)
    for x, y in itertools.combinations(n, 2):
        if one_edit(x, y):
            near[x].add(y)
            near[y].add(x)
    form = {w: (b if near[w] and n[b := min(near[w], key=lambda v: (-n[v], v))] >= times * n[w] else None) for w in n}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def spelled(seed, size, letters, low, high):
    rng = np.random.default_rng(seed)
    texts = []
    for i in range(size):
        some = ["".join(rng.choice(list(letters), int(rng.integers(low, high)))) for _ in range(30)]
        texts.append((i, " ".join(some * int(rng.integers(1, 4))), None, None))
    return texts


@pytest.mark.parametrize("block", [64, 2])
def test_variants(spark, block):
    rows = odd_rows() + [(200 + i, t, a, b) for i, t, a, b in spelled(3, 40, "abé", 5, 8)]
    got = spelling.group_variants(table(spark, rows), block=block).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == variants_by_hand(rows)


def test_variants_of_skewed_blocks_and_with_other_settings(spark):
    rows = [(i, " ".join(f"prefix{a}{b}suffix" for a in "abcdefgh" for b in "abcdéfgh") + f" prefix{'abc'[i % 3]}suffix" + " aaaaa" * i + " aaaaaa", None, None) for i in range(12)]
    got = spelling.group_variants(table(spark, rows), least=3, seldom=1, divisor=5, block=4).collect()
    assert {tuple(r) for r in got} == variants_by_hand(rows, 3, 1, 5)
    with pytest.raises(ValueError):
        spelling.group_variants(table(spark, rows), times=1)


def test_no_variants(spark):
    none = table(spark, [(1, None, "en", "a"), (2, "", None, "a"), (3, "word word", "de", "b")])
    assert spelling.group_variants(none).collect() == []
    assert spelling.group_variants(none.limit(0)).collect() == []
