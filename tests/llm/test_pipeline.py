import random

import pytest

import corpus_pipeline as pipeline
from timeloom.llm import langid, secret_scan, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"


def rows_of():
    rng = random.Random(4)
    words = {"en": [f"th{a}{b}ing" for a in "aeiou" for b in "rstlnd"], "de": [f"sch{a}{b}ung" for a in "aeiou" for b in "rstlnd"]}
    made = []
    for i in range(150):
        lang = ("en", "de")[i % 2]
        text = " ".join(rng.choices(words[lang], k=40)) + (". vile scum here" if i % 10 == 0 else "") + (f' token = "{rng.randbytes(20).hex()}" end' if i % 7 == 0 else "")
        made.append((i, text, lang, "s", len(text), 1))
    copy = made[3][1] + " more"
    made += [(500, copy, "de", "s", len(copy), 1), (500, made[5][1] + " clean other words of its own now", "de", "s", 1, 1), made[9], made[9]]
    other = " ".join(rng.sample(words["de"], 30))
    return [*made, (3, other, "de", "s", len(other), 1), (600, None, None, "s", None, 1), (601, "", "en", "s", 0, 1)]


def key(r):
    return tuple((x is None, x) for x in r)


def brute_near(rows):
    rows = sorted({(r[0], r[1]): r for r in rows}.values(), key=lambda r: (r[0], r[1] or ""))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()} for w in ((r[1] or "").split() for r in rows)]
    part = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    part[i] = part[j] = min(part[i], part[j])
        if part == [part[p] for p in part]:
            break
    return [r[:5] for i, r in enumerate(rows) if part[i] == i]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows_of(), SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(150)], "doc_id long, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_near_duplicates_by_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*pipeline.COLUMNS).collect()]
    got = sorted((tuple(r) for r in pipeline.one_of_each_group(spark, docs, folder).collect()), key=key)
    assert got == sorted(brute_near(rows), key=key)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*pipeline.COLUMNS).collect()]
    got = {name: sorted((tuple(r) for r in stage(spark, docs, folder).collect()), key=key) for name, stage in pipeline.STAGES[:4] if name != "near_duplicates"}
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"), pipeline._fold(3) != 1)
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("score >= 0.7").collect()}
    assert toxic and got["toxicity"] == sorted((r for r in rows if r[0] not in toxic), key=key)
    kept = langid.fit(docs, pipeline._fold(5) != 0).decide([r[1] or "" for r in rows])[2]
    assert 0 < kept.sum() < len(rows) and got["language"] == sorted((r for r, k in zip(rows, kept, strict=True) if k), key=key)
    spans = secret_scan.all_spans([r[1] or "" for r in rows], secret_scan.fit(docs))[1]
    masked = [(r[0], t, *r[2:4], len(t)) if s else r for r, s, t in ((r, s, secret_scan.masked(r[1] or "", s)) for r, s in zip(rows, spans, strict=True))]
    assert sum(map(len, spans)) >= 20 and got["secrets"] == sorted(masked, key=key)


def test_run_and_an_empty_table(spark, folder, tmp_path):
    assert {"sequence_id", "doc_id", "offset", "length"} <= set(pipeline.run(spark, folder).columns)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
