import random
from collections import Counter

import pytest

from riskloom.llm import suffixes
from riskloom.llm.column_bwt import Collection
from tests.llm.frames import DOCS, awkward, empty, planted, sentence


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    starts = Counter(t[p:p + 200] for t in texts for p in range(len(t) - 199))
    out = Counter()
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t) + 1)
        for p in range(len(t) - 199):
            if starts[t[p:p + 200]] > 1:
                gone[p:p + 200] = b"\1" * 200
        spans = sum(1 for p in range(len(t)) if gone[p] and not (p and gone[p - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[i, len(t), len(t) - len(kept), spans, kept] += 1
    return out


def crowded(spark):
    """Passages just above and below the width, in many surroundings; periods; the zero character; wide characters."""
    rng = random.Random(8)
    passage = [sentence(rng, 80)[:n] for n in (199, 200, 201, 230, 290, 420)]
    texts = [sentence(rng, rng.randint(0, 40)) + rng.choice(passage) + sentence(rng, rng.randint(0, 40)) for _ in range(90)]
    texts += ["ab" * 300, "x" * 700, "x" * 199, "x" * 200, "\x00" * 450, "日本語" * 100 + sentence(rng, 50), "日本語" * 70 + "é" * 120]
    texts += [texts[0][:150] + "\x00" + texts[0][151:], "short", texts[3]]
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)


@pytest.mark.parametrize("make, shard_bytes, strings, crowd", [
    (planted, 4_000_000, 600, 8_000), (planted, 3_000, 7, 8_000), (planted, 4_000_000, 600, 0), (awkward, 4_000_000, 600, 8_000),
    (awkward, 500, 3, 0), (crowded, 4_000_000, 600, 8_000), (crowded, 20_000, 20, 8), (crowded, 4_000_000, 600, 0)])
def test_equals_brute_force(spark, make, shard_bytes, strings, crowd):
    docs = make(spark)
    got = suffixes.remove_repeats(docs, shard_bytes=shard_bytes, strings=strings, crowd=crowd).collect()
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_empty_table(spark):
    assert suffixes.remove_repeats(empty(spark)).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = sentence(random.Random(1), 1500).encode()
    pieces = []
    monkeypatch.setattr(suffixes, "_PIECE", 300)
    hashes, _, places = suffixes.segments(text)
    for h, p in zip(hashes.tolist(), places.tolist()):
        pieces += [(w, h, (p >> 14) + (p & 127)) for w in range(p >> 14, (p >> 14) + (p >> 7 & 127))]
    monkeypatch.setattr(suffixes, "_PIECE", 1 << 18)
    hashes, _, places = suffixes.segments(text)
    whole = [(w, h, (p >> 14) + (p & 127)) for h, p in zip(hashes.tolist(), places.tolist()) for w in range(p >> 14, (p >> 14) + (p >> 7 & 127))]
    assert pieces == whole and [w for w, *_ in whole] == list(range(len(text) - 199))


def test_transform_and_common_prefixes_equal_sorted_suffixes():
    rng = random.Random(2)
    for _ in range(300):
        strings = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 9))]
        strings += [rng.choice(strings)] * rng.randint(0, 2)
        made = Collection(strings)
        order = sorted(((s[i:] + b"\0", k, i) for k, s in enumerate(strings) for i in range(len(s) + 1)), key=lambda x: x[:2])
        symbols = [0] * len(order)
        for e in made.entries.tolist():
            symbols[e & (1 << 24) - 1] = e >> 24
        assert symbols == [strings[k][i - 1] if i else 0 for _, k, i in order]
        common = [0]
        for (a, *_), (b, *_) in zip(order, order[1:]):
            n = 0
            while n < min(len(a), len(b)) - 1 and a[n] == b[n]:
                n += 1
            common.append(n)
        assert made.lcp.tolist() == common
        for width in (1, 3, 5):
            starts = Counter(s[i:i + width] for s in strings for i in range(len(s) - width + 1))
            want = [[i for i in range(len(s) - width + 1) if starts[s[i:i + width]] > 1] for s in strings]
            assert [x.tolist() for x in made.repeated(width)] == want
