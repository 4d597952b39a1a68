"""The pipeline's stages against plain restatements on a small table, and its contract."""

import ast
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from isobar.llm import language, ordinal, pii
from isobar.llm.queries import ORACLE, QUERIES
from cases import SMALL, empty_documents, odd_documents, odd_rows
from test_simhash import classes, fingerprint


def staged(spark, sf_dir, docs, tmp_path):
    """Every stage's rows, each stage reading what the one before wrote."""
    out = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}-{name}")
        docs = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        out.append(docs)
    return out


def test_stages_equal_plain_restatements(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    quality, languages, single, clean, packed = staged(spark, SMALL, docs, tmp_path)
    rows = [r.asDict() for r in docs.collect()]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = ordinal.learn(docs, labels)
    tails = {r.doc_id: r.tail_probability for r in ordinal.score(docs, model).collect()}
    rows = [r for r in rows if tails[r["doc_id"]] >= corpus_pipeline.LEAST_QUALITY]
    key = lambda rs: sorted(map(str, rs))
    assert key(r.asDict() for r in quality.collect()) == key(rows)
    bad = {r.doc_id for r in labels.collect() if r.quality == 0}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    kept = {r["doc_id"] for r in rows}
    assert len(good - kept) <= 0.02 * len(good) and len(bad & kept) <= 0.05 * len(bad)

    ranker = language.Ranker(language.learn(quality))
    scored = [(r, *ranker.predict(language.letters(pa.array([r["text"]]))[0])) for r in rows]
    rows = [r for r, name, score in scored if name != "und" and score >= corpus_pipeline.LEAST_LANGUAGE]
    assert key(r.asDict() for r in languages.collect()) == key(rows)

    prints = {r["doc_id"]: fingerprint(r["text"]) for r in rows}
    group = classes(list(prints.values()))
    first = {}
    for i, p in prints.items():
        first[group[p]] = min(i, first.get(group[p], i))
    rows = [r for r in rows if first[group[prints[r["doc_id"]]]] == r["doc_id"]]
    assert key(r.asDict() for r in single.collect()) == key(rows)

    field = pii.learn(single)
    got = {r.doc_id: r for r in clean.collect()}
    assert set(got) == {r["doc_id"] for r in rows}
    for r in rows:
        _, spans = pii.spans_of(pa.array([r["text"]]), field)
        text = pii.replaced(r["text"], spans[0])
        assert got[r["doc_id"]].asDict() == {**r, "text": text, "n_chars": len(text)}

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = {i: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in got.items()}
    lengths, loads = {}, {}
    for r in packed.collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
        loads[r.sequence_id] = loads.get(r.sequence_id, 0) + r.length
    assert lengths == want and max(loads.values()) <= 2048
    assert len(loads) <= -(-sum(want.values()) // 2048) * 1.01 + 1


def test_run_equals_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    last = staged(spark, SMALL, docs, tmp_path)[-1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, last.select(columns).collect()))


def test_stages_keep_columns_and_survive_odd_rows(spark, tmp_path):
    for docs in (odd_documents(spark, "score", "fp", "spans"), empty_documents(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SMALL).columns == docs.columns, name
            assert stage(spark, docs, SMALL).count() <= len(odd_rows())
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_registered_queries_read_whole_tables(spark):
    names = {n: f"op{n}_" for n in range(1, 14)}
    assert all(sum(q.startswith(p) for q in QUERIES) == 1 for p in names.values())
    assert set(ORACLE) <= set(QUERIES)
    source = (Path(__file__).resolve().parents[2] / "isobar" / "llm" / "queries.py").read_text()
    calls = {n.func.attr for n in ast.walk(ast.parse(source)) if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute)}
    assert not calls & {"limit", "sample", "localCheckpoint", "crossJoin"}


def test_every_query_gives_its_contract_columns(spark):
    want = {
        "op2_syncmer_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op3_grouping_packing": "doc_id piece start length ids_crc32 sequence_id offset",
        "op4_simhash_components": "doc_id fingerprint component_id",
        "op5_crf_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op6_exact_topk": "query_id rank vec_id score",
        "op7_toxicity_fm": "doc_id held_out score predicted",
        "op8_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op9_entropy_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op10_language_rank": "doc_id held_out lang_pred score",
        "op12_bpe_backtracking": "doc_id n_tokens ids_sha256 decoded_sha256",
    }
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name, columns in want.items():
        df = QUERIES[name](spark, SMALL)
        assert set(columns.split()) <= set(df.columns), name
        if name not in ("op3_grouping_packing", "op6_exact_topk"):
            assert df.count() == n, name
    assert np.all([r.accepted in (True, False) for r in QUERIES["op1_quality_ordinal"](spark, SMALL).collect()])


def test_language_stage_rejects_other_languages_and_keeps_learned_ones(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    other = {
        -1: "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        -2: "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        -3: "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        -4: "Все люди рождаются свободными и равными в своем достоинстве и правах.", -5: "12345 67890 !!!", -6: None,
    }
    learned = {
        -11: "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience.",
        -12: "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt.",
    }
    rows = [(i, t, None, "s", len(t or "")) for i, t in {**other, **learned}.items()]
    every = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.languages(spark, every, SMALL).collect()}
    assert not kept & set(other) and set(learned) <= kept
    named = {r.doc_id for r in docs.filter("lang IS NOT NULL AND length(text) > 40").collect()}
    assert named <= kept
