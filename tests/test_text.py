import hashlib
import urllib.parse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import chunks, embed, generate, knn, prompts


def windows(spark, value, size, overlap):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(text.char_windows(F.col("t"), size, overlap).alias("w")).first().w


def by_loop(value, size, overlap):
    step = max(1, size - overlap)
    cut = (value[i : i + size] for i in range(0, len(value), step))
    return [w for w in cut if w.strip()]


@pytest.mark.parametrize(
    "value, size, overlap",
    [
        ("abcdefghij", 5, 2),
        ("a" * 1000, 100, 0),
        ("short", 500, 50),
        ("", 5, 2),
        ("hello" + " " * 500 + "world", 50, 0),
        ("abcdef", 3, 5),
        ("abcdefgh", 2, -1),
        ("x😀y\n😀z" * 9, 4, 3),
        ("a  \u0085\x1c b", 1, 0),
        ("line\r\nline end", 3, 1),
    ],
)
def test_windows(spark, value, size, overlap):
    assert windows(spark, value, size, overlap) == by_loop(value, size, overlap)


def test_windows_of_nothing(spark):
    assert windows(spark, None, 5, 0) is None
    with pytest.raises(ValueError):
        text.char_windows(F.col("t"), 0, 0)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(st.sampled_from("ab \n\t 　é😀\x1f"), max_size=60), min_size=1, max_size=20
    ),
    st.integers(1, 9),
    st.integers(-2, 9),
)
def test_windows_like_a_loop(spark, values, size, overlap):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string").coalesce(1)
    got = df.select("i", text.char_windows(F.col("t"), size, overlap).alias("w")).collect()
    assert {r.i: r.w for r in got} == {
        i: by_loop(v, size, overlap) for i, v in enumerate(values)
    }


def test_index_counts_kept_windows(spark):
    docs = spark.createDataFrame([("d", "ab" + " " * 6 + "cd"), ("e", None)], "doc string, text string")
    got = chunks.chunk_documents(docs, size=2, overlap=0).collect()
    assert [(r.doc, r.chunk_index, r.chunk) for r in got] == [("d", 0, "ab"), ("d", 1, "cd")]


def test_keys(spark):
    docs = spark.createDataFrame([("docs/a.txt", "abcdef")], "k string, text string")
    cut = chunks.chunk_documents(docs, size=3, overlap=0)
    got = chunks.keyed_chunks(cut, F.lit("b"), F.col("k")).collect()
    assert [r.key for r in got] == [
        hashlib.sha1(f"docs/a.txt#{i}".encode()).hexdigest() for i in range(2)
    ]
    assert got[1].metadata.asDict() == {
        "source_bucket": "b",
        "source_key": "docs/a.txt",
        "chunk_index": 1,
        "text": "def",
    }


KEYS = ["a%20b", "a+b", "a%2Bb", "100%", "%zz%41", "%C3%A9", "%", "plain", "a%2", "%e2%82%ac+%25"]


def test_unquote(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    got = df.select(text.url_unquote(F.col("k")).alias("u")).collect()
    assert [r.u for r in got] == [urllib.parse.unquote_plus(k) for k in KEYS]


def test_few_bytes_of_text_are_cut_at_once(monkeypatch):
    """An Arrow batch of long texts is cut into words part by part, each text whole."""
    monkeypatch.setattr(embed, "TEXT_BYTES", 100)
    texts = pa.array(["a " * n for n in (10, 20, 30, 300, 0, 0, 1, 40, 10)])
    parts = list(embed._slices(texts, 4))
    assert pa.concat_arrays(parts).equals(texts)
    assert all(len(p) <= 4 and (len(p) == 1 or pc.sum(pc.binary_length(p)).as_py() <= 100) for p in parts)
    assert [len(p) for p in parts] == [2, 1, 1, 4, 1]
    assert not list(embed._slices(texts.slice(0, 0), 4))


def test_hashed_vector(spark):
    said = ["The cat the CAT", "", None, " \n ", "one\ttwo\r\nthree  one"]
    df = spark.createDataFrame([(s,) for s in said], "t string")
    got = [r.vector for r in embed.embed(df, "t", dims=16).collect()]
    assert got.pop(2) is None and said.pop(2) is None
    for value, vector in zip(said, got):
        counts = np.zeros(16)
        for word in value.lower().split():
            counts[int(hashlib.sha1(word.encode()).hexdigest()[:8], 16) % 16] += 1
        norm = np.linalg.norm(counts)
        assert vector == pytest.approx(counts / norm if norm else counts, abs=1e-6)


def test_words_and_their_buckets(monkeypatch):
    """Runs of blanks, other blanks and zero bytes; a slice of texts has the words of that slice."""
    texts = pa.array(["skipped", " a\t\r\nb  \u00a0c\n", "", "\0 \0\0 é a", "\x0b\t"]).slice(1)
    monkeypatch.setattr(embed, "WORDS", 3)
    words = embed._words(texts)
    assert [[w for w in text if w] for text in words.to_pylist()] == [
        ["a", "b", "\u00a0c"], [], ["\0", "\0\0", "é", "a"], ["\x0b"]
    ]
    flat = words.flatten()
    want = [int(hashlib.sha1(w.encode()).hexdigest()[:8], 16) % 999 if w else -1 for w in flat.to_pylist()]
    assert embed._token_buckets(flat, 999).tolist() == want
    assert not len(embed._token_buckets(flat.slice(0, 0), 999))


def test_model_is_loaded_per_task_and_checked(spark):
    df = spark.createDataFrame([("a",), ("bbb",), (None,)], "t string")

    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    got = embed.embed(df, "t", dims=2, load=load).collect()
    assert [r.vector for r in got] == [[1.0, 1.0], [3.0, 1.0], None]
    with pytest.raises(Exception, match="model gave shape"):
        embed.embed(df, "t", dims=3, load=load).collect()


def test_decode_vectors(spark):
    said = ['{"embedding":[1,2.5]}', '{"other":1}', '{"embedding":"no"}', "cut {", None]
    df = spark.createDataFrame([(s,) for s in said], "r string")
    got = [r.vector for r in embed.decode_vectors(df, "r").collect()]
    assert got == [[1.0, 2.5], None, None, None, None]


def test_decode_answers(spark):
    said = [
        '{"content":[{"type":"text","text":"yes\\n"},{"text":"no"}]}',
        '{"content":[]}',
        "{",
        '{"choices":[{"message":{"content":"maybe"}}]}',
        '{"choices":[{"message":{"content":null}}]}',
    ]
    df = spark.createDataFrame([(s,) for s in said], "r string")
    got = [r.answer for r in prompts.decode_answers(df, "r").collect()]
    assert got == ["yes\n", None, None, "maybe", None]


HIT = (
    "q string, rank int, metadata struct<source_bucket:string,source_key:string,"
    "chunk_index:int,text:string>"
)


def test_prompts(spark):
    asked = spark.createDataFrame([("1", "Why?"), ("2", "How?")], "q string, question string")
    hits = spark.createDataFrame(
        [("1", 2, (None, None, None, None)), ("1", 1, ("b", "k.txt", 3, "body"))], HIT
    )
    got = {r.q: r.prompt for r in prompts.build_prompts(asked, hits, "q", "question").collect()}
    assert got == {
        "1": "Context:\n[Source: k.txt chunk 3]\nbody\n\n---\n\n"
        "[Source: unknown chunk ?]\n\n\nQuestion: Why?",
        "2": "Context:\n\n\nQuestion: How?",
    }


def test_retrieval_finds_the_chunk(spark):
    rows = [("k1", "apple pear plum"), ("k2", "car bus tram"), ("k3", "red green blue")]
    corpus = spark.createDataFrame(rows, "key string, body string").select(
        "key",
        F.struct(
            F.lit("b").alias("source_bucket"),
            F.col("key").alias("source_key"),
            F.lit(0).alias("chunk_index"),
            F.col("body").alias("text"),
        ).alias("metadata"),
    )
    corpus = embed.embed(corpus, "metadata.text", dims=256)
    asked = spark.createDataFrame([("q", "bus or tram")], "q string, question string")
    got = prompts.retrieve_prompts(asked, corpus, "q", "question", k=1, dims=256).first()
    assert got.prompt == "Context:\n[Source: k2 chunk 0]\ncar bus tram\n\nQuestion: bus or tram"


def test_replies(spark):
    said = ["a", None, "boom", "ccc"]
    df = spark.createDataFrame([(s,) for s in said], "t string").coalesce(1)

    def load():
        def model(texts):
            if "boom" in texts:
                raise RuntimeError("cannot")
            return [t.upper() for t in texts]

        return model

    got = df.select(generate.model_text(F.col("t"), load, isolate=True).alias("r")).collect()
    assert [r.r for r in got] == ["A", None, None, "CCC"]
    with pytest.raises(Exception, match="cannot"):
        df.select(generate.model_text(F.col("t"), load)).collect()
    with pytest.raises(Exception, match="replies"):
        df.select(generate.model_text(F.col("t"), lambda: lambda texts: [])).collect()


def test_answers(spark):
    corpus = spark.createDataFrame(
        [("k", "blue sky"), ("l", "green grass")], "key string, body string"
    ).select(
        "key",
        F.struct(
            F.lit("b").alias("source_bucket"),
            F.col("key").alias("source_key"),
            F.lit(0).alias("chunk_index"),
            F.col("body").alias("text"),
        ).alias("metadata"),
    )
    corpus = embed.embed(corpus, "metadata.text", dims=64)
    asked = spark.createDataFrame([("1", "the sky"), ("2", "fail")], "q string, question string")

    def reply():
        import json

        def model(bodies):
            out = []
            for body in bodies:
                request = json.loads(body)
                if "Question: fail" in request["messages"][0]["content"]:
                    raise RuntimeError
                out.append(json.dumps({"content": [{"text": str(sorted(request))}]}))
            return out

        return model

    got = prompts.answer_questions(asked, corpus, "q", "question", reply, k=1, dims=64)
    assert {r.q: r.answer for r in got.collect()} == {
        "1": "['anthropic_version', 'max_tokens', 'messages', 'system']",
        "2": None,
    }


def test_query_chunks(spark):
    rows = [("a", [1.0, 0.0], "x"), ("b", [0.0, 1.0], "y"), ("c", [1.0, 1.0], "z")]
    chunks_ = spark.createDataFrame(rows, "key string, vector array<float>, metadata string")
    got = knn.query_chunks(chunks_, [1.0, 0.1], 2).collect()
    assert [(r.key, r.metadata) for r in got] == [("a", "x"), ("c", "z")]
    assert knn.query_chunks(chunks_.limit(0), [1.0, 0.1]).collect() == []
