import importlib

from test_decontaminate import brute_force as leaks
from test_near_dup import groups
from test_quality import expected
from test_tokens import ENCODING

from revlake.llm.kneser_ney import ORDER
from revlake.llm.pii import Feistel, pseudonymise

SF = "/root/testdata/sf0.001"


def test_matches_brute_force(spark):
    corpus_pipeline = importlib.import_module("corpus_pipeline")
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()]
    docs = [(i, lang, text) for i, text, lang, _, _ in read("documents")]
    keep = expected(spark, docs, read("labels"), ORDER)
    docs = [(d[0], d[2]) for k, d in enumerate(docs) if keep[k][2]]
    root = groups(docs)
    docs = [d for d in docs if root[d[0]] == d[0]]
    gone = {i for i, *_ in leaks(docs, read("benchmark"))}
    docs = [d for d in docs if d[0] not in gone]
    want = {i: ENCODING.encode_ordinary(pseudonymise(t, Feistel())[0]) for i, t in docs}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert len(got) == len(want) > 100 and gone and len(root) > len(docs)
    assert all(got[i].tokens == want[i] and got[i].round_trip for i in want)


def test_stages_keep_columns_and_end_on_empty_tables(spark):
    corpus_pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_stages_on_nulls_repeats_and_clashing_columns(spark, tmp_path):
    """Each case of the docstring through all stages, with columns named like those that the operators use inside."""
    corpus_pipeline = importlib.import_module("corpus_pipeline")
    trusted = [f"the quiet river {w} runs past old stone houses and the people {w} walk home in the evening light number {i}" for i, w in enumerate("amber birch cedar dune ember frost grove haze iris juniper".split() * 3)]
    item = "which of the following planets in the solar system has the greatest number of known moons"
    copy = "a text that is there several times and in full with quite ordinary words of the river and the houses"
    rows = [(i, t, "en") for i, t in enumerate(trusted)]
    rows += [(100, None, "en"), (101, "", "en"), (102, None, None), (103, "some words without a language", None), (None, "no id " + copy[::-1], None)]
    rows += [(200, copy, None), (200, copy, None), (201, copy, None), (None, copy, None)]
    rows += [(300, f"before {item} after", None), (301, "write to jane.doe@example.com soon", None), (302, "q9x zzkw vvbj " * 60, "en"), (303, "word " * 100_000, None)]
    names = ["node", "id", "row", "may", "band", "model", "stays", "kept", "item_id", "kinds"]
    docs = spark.createDataFrame([(*([k] * len(names)), t, i, lang, "s", len(t or "")) for k, (i, t, lang) in enumerate(rows)], ", ".join(f"{n} int" for n in names) + ", text string, doc_id long, lang string, source string, n_chars long")
    folder = str(tmp_path)
    spark.createDataFrame([(i, 1, 0) for i in range(len(trusted))] + [(302, 0, 0), (302, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, ""), (None, item), (1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "encoding":
            assert docs.columns[:10] == names and docs.schema["text"].dataType.simpleString() == "string"
        docs.write.parquet(f"{folder}/out-{name}")
        docs = spark.read.parquet(f"{folder}/out-{name}")
        seen[name] = docs.collect()
    ids = lambda name: {r.doc_id for r in seen[name]}
    assert ids("quality") >= {100, 101, 102, 103, 200, 201, 300, 301, 303, None} and 302 not in ids("quality")
    copies = [r for r in seen["near_duplicates"] if r.text == copy]
    assert [r.doc_id for r in copies] == [200] and {100, 101, 102} <= ids("near_duplicates")
    assert ids("near_duplicates") - ids("decontamination") == {300}
    text = {r.doc_id: r.text for r in seen["pseudonyms"]}
    assert "jane.doe" not in text[301] and text[301].endswith("@example.com soon") and len(seen["pseudonyms"]) == len(seen["decontamination"])
    last = {r.doc_id: r for r in seen["encoding"]}
    assert last[100].tokens is None and last[101].tokens == [] and last[303].n_tokens > 90_000 and all(r.round_trip for r in seen["encoding"] if r.tokens is not None)
