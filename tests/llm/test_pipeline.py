"""The pipeline against brute force, stage after stage, on the awkward corpus."""

import base64
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from hazardflow.llm import decontaminate, language_id, merge_replay
from hazardflow.llm.store import crc_fold
from llm.conftest import words
from llm.test_decontaminate import distance
from llm.test_language_id import plain_log_sum
from llm.test_line_dedup import expected as without_repeats
from llm.test_ngram_join import expected as components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = corpus.select(*COLUMNS)
    docs.write.parquet(f"{path}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    items = [(1, text[104][:180]), (2, text[108][20:200].upper()), (3, "not in any document at all, whatever it says"), (4, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def in_a_language(spark, folder, docs):
    """Rows that are not a thousand times likelier in no learned language; sums by plain Python."""
    tokens = merge_replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    table = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.fit(table.filter(crc_fold(F.col("doc_id"), 4) != 2), tokens)
    names = sorted({t for t in tokens if t} | {bytes([b]) for b in range(256)})
    longest, known = max(map(len, names)), {}
    teaching = [r.text for r in table.filter(crc_fold(F.col("doc_id"), 4) != 2).filter("text IS NOT NULL AND lang IS NOT NULL").collect()]
    split = lambda text: [b" " + w for w in re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), text.encode()))]
    seen = np.bincount(np.frombuffer(b"".join(w for t in teaching for w in split(t)), np.uint8), minlength=256)
    byte = np.log(0.5 * seen / seen.sum() + 0.5 / 256)
    tables = [dict(zip(names, column)) for column in np.exp(model["log_p"]).T] + [dict.fromkeys(names, 1 / len(names))]

    def log_sums(word):
        if word not in known:
            known[word] = [plain_log_sum(word, p, longest) for p in tables] + [byte[np.frombuffer(word, np.uint8)].sum()]
        return known[word]

    def judged(text):
        if not any(c.isalpha() for c in text or ""):
            return False
        sums = np.sum([log_sums(w) for w in split(text)], axis=0)
        best = int(np.argmax(sums[:-2] + model["prior"]))
        return sums[best] - max(sums[-2:]) > -np.log(1000)

    return [(i, t) for i, t in docs if judged(t)]


def brute_force(rows, items):
    kept = without_repeats(rows, 50)
    rows = [(i, kept[i, t][0]) for i, t in rows]
    group = {i: c for i, _, c, _ in components(rows)}
    # a row goes if its id is not the least of its component, whatever its own text
    rows = [(i, t) for i, t in rows if i is None or group[i] == i]
    # of equal rows with an id and a word one stays
    rows = [r for k, r in enumerate(rows) if r[0] is None or not r[1].split() or r not in rows[:k]]
    leaked = lambda t: any(
        a and distance(a, decontaminate.normal(t)) <= int(0.05 * len(a)) for a in map(decontaminate.normal, items))
    return [(i, t) for i, t in rows if not leaked(t)]


def test_run_equals_brute_force(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = in_a_language(spark, folder, docs)
    assert len(docs) > 30
    # plain edit tables and all runs of lines would take too long on these, which hold no copy and no item
    short = [(i, t) for i, t in docs if len(t) < 20_000]
    long = [(i, t) for i, t in docs if len(t) >= 20_000]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(str((i, library.encode_ordinary(t))) for i, t in brute_force(short, items) + long)
    got = corpus_pipeline.run(spark, folder)
    assert sorted(str((r.doc_id, list(r.ids))) for r in got.collect()) == want


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == COLUMNS
    assert len(corpus_pipeline.STAGES) == 5


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_exact_copies_leave_one_row(spark, tmp_path):
    """Copies long enough for line dedup, and short ones that only the join sees; empty texts are no copies."""
    rnd = random.Random(11)
    groups = [words(rnd, 240), words(rnd, 60), words(rnd, 20)]
    texts = [" ".join(group) for group in groups]
    texts[0] = "\n".join(" ".join(groups[0][k : k + 12]) for k in range(0, 240, 12))
    rows = [(10 * copy + g, text) for g, text in enumerate(texts) for copy in range(1, 6)]
    rows += [(90, "a \n\n " + texts[0]), (91, "-- 12"), (92, ""), (93, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    deduped = corpus_pipeline.remove_repeated_lines(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in deduped) == [10, 11, 12, 22, 32, 42, 52, 90, 91, 92, 93]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "in no document of these")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == [10, 11, 12, 90]
    assert all(len(r.ids) for r in got)


def test_no_language_to_learn_keeps_lettered_documents(spark, tmp_path):
    rows = [(1, "some words", None, "s", 0), (2, "12 --", None, "s", 0), (3, None, None, "s", 0), (4, "你好", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
    assert got.columns == COLUMNS and sorted(r.doc_id for r in got.collect()) == [1, 4]


def test_clashing_names_stay_whole(spark, corpus, tmp_path):
    """Columns with names that the stages use inside come through all filtering stages unchanged."""
    extra = ["lettered", "margin", "lang_pred", "score", "c0", "__lettered", "row", "removed", "doc_key", "cuts", "k0"]
    docs = corpus.select(*COLUMNS, *[F.lit(f"own {name}").alias(name) for name in extra])
    spark.createDataFrame([(1, "in no document")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns, name
        rows = got.select(*extra).distinct().collect()
        assert [list(r) for r in rows] == [[f"own {x}" for x in extra]], name


def test_equal_rows_leave_one(spark, tmp_path):
    rows = [(1, "these are some words of a short text", "en", "s", 0)] * 3 + [(2, None, "en", "s", 0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()) == [1, 2, 2]


def test_table_without_languages(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words"), (2, "--")], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs, str(tmp_path)).collect()] == [1]
