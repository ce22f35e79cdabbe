"""What the operators write between their steps."""

import random

from pyspark.sql import functions as F

from leafmill.llm import jaccard


def test_jaccard_writes_prefixes_and_only_shared_keys(spark, monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(str(draw.randrange(10**6)) for _ in range(400)) for _ in range(60)]
    texts.append(texts[7].replace(texts[7].split()[200], "other"))
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[3]), (101, None), (102, "")]
    held, keep = [], jaccard.written

    def noted(spark, df, *args, **named):
        out = keep(spark, df, *args, **named)
        wide = [c for c, kind in out.dtypes if kind == "binary"]
        size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in wide), F.lit(0))
        held.append((out.columns, out.count(), out.agg(F.sum(size)).first()[0]))
        return out

    monkeypatch.setattr(jaccard, "written", noted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["id"]: r["component_id"] for r in jaccard.join_components(df).collect()}
    assert found == {i: i for i, _ in rows} | {60: 7, 100: 3}
    whole = 8 * 396 * 61
    assert max(size or 0 for _, _, size in held) < whole / 3
    # Keys that one set alone has are not joined.
    assert all(count < 61 * 80 / 10 for columns, count, _ in held if "key" in columns)
