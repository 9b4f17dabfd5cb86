import random

import corpus_pipeline as C
from quakehouse.llm.queries import table

WORDS = {"de": "der und nicht ist sich auch wird einen nach", "en": "the and with that this from which have they",
         "fr": "les des dans pour avec sont cette mais nous"}
UNKNOWN = "xqzv kwpj vvbq zzkx jjqw"


def line(seed, lang, n):
    r = random.Random(f"{seed} {lang}")
    common = WORDS[lang].split()
    return [r.choice(common) + (str(r.randrange(10**6)) if i % 3 == 0 else "") for i in range(n)]


def corpus():
    rows = [(i, " ".join(line(i, lang, 90)), lang) for i in range(90) for lang in [sorted(WORDS)[i % 3]]]
    passage = line("shared", "en", 60)
    rows += [(200 + i, " ".join(line(f"l{i}", "en", 40) + passage + line(f"r{i}", "en", 40)), None) for i in range(3)]
    rows += [(300, rows[0][1], "de"), (301, rows[0][1], "de")]  # exact copies of 0
    near = rows[1][1].split()
    rows += [(310, " ".join([*near[:-1], "other"]), None)]  # one word of 1 differs
    rows += [(320, " ".join(line("a", "de", 30) + line("b", "fr", 30)), None)]  # switches
    return rows + [(400, None, None), (401, "", "en"), (402, "12 - 34 !", "en"), (403, (UNKNOWN + " ") * 20, None)]


def test_stages_match_brute_force(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept, text = [], {}
    for name, stage in C.STAGES[:-1]:
        out = tmp_path / name
        stage(spark, docs, "").write.parquet(str(out))
        docs = spark.read.parquet(str(out))
        assert docs.columns == ["doc_id", "text", "lang"]
        text = {r.doc_id: r.text for r in docs.collect()}
        kept.append(set(text))
        print(name, len(text))
    lettered = {i for i, _, _ in rows} - {400, 401, 402, 403}
    assert kept[0] == lettered
    assert kept[1] == lettered - {0, 300}  # the largest doc_id of equal texts stays
    assert kept[2] | {1, 310} == kept[1] and len(kept[2] & {1, 310}) == 1 and kept[3] == kept[2]
    said = dict((i, t) for i, t, _ in rows)
    shared = " ".join(line("shared", "en", 60))
    assert [i for i in sorted(text) if shared in text[i]] == [200]
    for i in (201, 202):
        assert text[i].split() == [w for w in said[i].replace(shared, " ").split()]
    assert all(text[i] == said[i] for i in text if i not in (201, 202))
    assert {r.doc_id for r in C.STAGES[-1][1](spark, docs, "").select("doc_id").distinct().collect()} == kept[3]


def test_language_stage_without_labels_keeps_lettered_documents(spark):
    rows = [(i, t, None) for i, t, _ in corpus()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in C.language_id(spark, docs, "").collect()} == {i for i, _, _ in rows} - {400, 401, 402}


def test_language_stage_keeps_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    assert C.language_id(spark, docs, "").count() == docs.filter(docs.text.rlike(r"\p{L}")).count()


def test_language_stage_leaves_columns_alone(spark):
    rows = [(*r, -7.0, "mine", 5, True) for r in corpus()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string, __sure int, __letter boolean")
    out = C.language_id(spark, docs, "")
    assert out.columns == docs.columns
    kept = out.collect()
    assert len(kept) > 50 and sorted(map(tuple, kept), key=str) == sorted((r for r in rows if r[0] in {k.doc_id for k in kept}), key=str)
    assert C.language_id(spark, docs.limit(0), "").count() == 0
