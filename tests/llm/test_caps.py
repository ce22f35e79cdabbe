"""Language sets and secrets of any size: cases that a cap once cut."""

import random
import string

import numpy as np

from leafmill.llm import langid, secrets


def languages(count, rng):
    """Words of so many invented languages, each with letters of its own."""
    out = {}
    for k in range(count):
        letters = [chr(0x4E00 + 12 * k + j) for j in range(12)]
        out[f"l{k:03d}"] = ["".join(rng.choices(letters, k=rng.randint(3, 7))) for _ in range(60)]
    return out


def plain_em(likely, chosen, start, turns):
    """Proportions and log-likelihood of one text by plain loops over words and languages."""
    share = [p if k in chosen else 0.0 for k, p in enumerate(start)]
    share = [p / sum(share) for p in share]
    for _ in range(turns):
        sums = [0.0] * len(share)
        for word in likely:
            joint = [w * p for w, p in zip(word, share)]
            for k, j in enumerate(joint):
                sums[k] += j / sum(joint)
        share = [max(s / len(likely), 1e-9) if k in chosen else 0.0 for k, s in enumerate(sums)]
        share = [p / sum(share) for p in share]
    return share, sum(np.log(sum(w * p for w, p in zip(word, share))) for word in likely)


def test_six_languages_in_equal_parts(spark):
    rng = random.Random(4)
    known = languages(8, rng)
    rows = [(k, " ".join(rng.choices(w, k=400)), lang) for k, (lang, w) in enumerate(known.items())]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = langid.fit(frame)
    mixed = [w for lang in list(known)[:6] for w in rng.choices(known[lang], k=50)]
    rng.shuffle(mixed)
    shares, _ = langid.mixtures([" ".join(mixed), " ".join(known["l007"])], model[1])
    assert np.allclose(shares[0][:6], 1 / 6, atol=0.02) and not shares[0][6:].any()
    assert shares[1][7] > 0.99
    row = langid.predict(frame.limit(0).union(spark.createDataFrame([(9, " ".join(mixed), None)], frame.schema)), model).first()
    assert abs(row["score"] - 1 / 6) < 0.02


def test_mixtures_equal_plain_expectation_maximisation(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(300)]
    rows = [(k, " ".join(rng.choices(words[40 * k : 40 * k + 120], k=500)), f"l{k}") for k in range(5)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    langs, model = langid.fit(frame)
    text = " ".join(rng.choices(words[:160], k=60))
    shares, sizes = langid.mixtures([text], model)
    buckets, starts, _ = langid.trigrams([text])
    likely = np.add.reduceat(model[buckets], starts, axis=0).astype(float)
    likely = np.exp(np.maximum(likely - likely.max(axis=1, keepdims=True), -60.0)).tolist()
    first, _ = plain_em(likely, set(range(5)), [0.2] * 5, langid.FULL_TURNS)
    ranked = sorted(range(5), key=lambda k: -first[k])
    tried = []
    for size in range(1, 6):
        turns = langid.SET_TURNS if 1 < size < 5 else 0
        share, value = plain_em(likely, set(ranked[:size]), first, turns)
        tried.append((value - (size - 1) * (0.5 * np.log(sizes[0]) + 2.0), -size, share))
    assert np.allclose(shares[0], max(tried)[2], atol=1e-6)


def test_more_than_256_languages(spark):
    rng = random.Random(5)
    known = languages(260, rng)
    rows = [(k, " ".join(w), lang) for k, (lang, w) in enumerate(known.items())]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    langs, model = langid.fit(frame)
    assert len(langs) == 260
    shares, _ = langid.mixtures([" ".join(known["l123"])], model)
    assert langs[int(shares[0].argmax())] == "l123"


def test_short_random_strings_are_found(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(6, 14))) for _ in range(3000)]
    alphabet = string.ascii_letters + string.digits
    rows = []
    for k in range(150):
        line = " ".join(rng.choices(words, k=120))
        rows.append((k, f"{line} password={''.join(rng.choices(alphabet, k=24))} {line}"))
    hidden = ["".join(rng.choices(alphabet, k=12)) for _ in range(20)]
    rows += [(1000 + k, f"{' '.join(words[:50])} {s} {words[60]}") for k, s in enumerate(hidden)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    model = secrets.fit(frame)
    found = secrets.find(frame, model).where("id >= 1000").collect()
    hits = [
        rows[r["id"] - 1000 + 150][1][s["start"] : s["end"]] for r in found for s in r["spans"]
    ]
    place = {c: k + 1 for k, c in enumerate(secrets.ALPHABET)}

    def evidence(token):
        codes = [0, *(place[c] for c in token)]
        return sum(model[a, b] for a, b in zip(codes, codes[1:]))

    assert set(hits) == {t for t in hidden + words[:61] if evidence(t) > 14} and len(hits) >= 3


def test_ratios_equal_the_sum_of_steps():
    rng = np.random.default_rng(2)
    model = rng.normal(size=(secrets.STATES, secrets.STATES))
    tokens = ["abcdefgh", "A1b2C3d4e5", "========", "zz/zz+zz"]
    place = {c: k + 1 for k, c in enumerate(secrets.ALPHABET)}
    want = []
    for token in tokens:
        codes = [0, *(place[c] for c in token)]
        want.append(sum(model[a, b] for a, b in zip(codes, codes[1:])))
    assert np.allclose(secrets.ratios(tokens, model), want)
