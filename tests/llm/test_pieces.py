import os
import random

import pytest
from pyspark.sql import types as T

from fairstream.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no piece model here")

TEXTS = ["", " ", "Hello  world", "a\n\nb\t c", "x" * 200, "▁ literal ▁▁", "naïve café über ñandú", "日本語 テキスト 🙂",
         "   leading and trailing   ", "the quick brown fox jumps over the lazy dog " * 30]


@pytest.fixture(scope="module")
def model():
    with open(pieces.MODEL, "rb") as f:
        return pieces.Model(f.read())


def test_without_dropout_equals_the_model(model):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    encoder = pieces.Encoder(model, rate=0)
    for text in TEXTS:
        if "▁" not in text:
            assert encoder.encode(text).tolist() == lib.encode(text), text


def test_both_agendas_agree_and_dropout_is_lossless(model):
    rnd = random.Random(3)
    for _ in range(300):
        chunk = " " + "".join(rnd.choice("theinoraés▁!") for _ in range(rnd.randint(1, 40)))
        for rate in (0.0, 0.1, 0.5, 1.0):
            drops = [pieces.Dropout(chunk, rate, 5, 2) for _ in range(2)]
            assert pieces.merge_short(chunk, model, drops[0]) == pieces.merge_long(chunk, model, drops[1])
    for rate in (0.0, 0.3, 1.0):
        encoder = pieces.Encoder(model, rate=rate)
        for text in TEXTS:
            assert model.decode(encoder.encode(text, "k").tolist()) == text


def test_batches_encode_as_single_texts(model):
    rnd = random.Random(8)
    many = TEXTS + [" ".join("".join(rnd.choice("theinoraés▁!\n") for _ in range(rnd.randint(1, 60)))
                             for _ in range(200)) for _ in range(20)]
    for rate in (0.0, 0.1, 0.6):
        one, two = pieces.Encoder(model, rate), pieces.Encoder(model, rate)
        keys = [str(i) for i in range(len(many))]
        for _ in range(2):
            got = two.encode_many(many, keys)
            assert [x.tolist() for x in got] == [one.encode(t, k).tolist() for t, k in zip(many, keys, strict=True)]
            two.room = 0


def test_dropout_varies_by_document_and_repeats_by_seed(model):
    text = TEXTS[-1]
    cuts = {k: pieces.Encoder(model, 0.2).encode(text, k).tolist() for k in "abcdef"}
    assert len({tuple(c) for c in cuts.values()}) > 1
    assert cuts["a"] == pieces.Encoder(model, 0.2).encode(text, "a").tolist()
    assert cuts["a"] != pieces.Encoder(model, 0.2, seed=99).encode(text, "a").tolist()
    assert len(cuts["a"]) > len(pieces.Encoder(model, 0).encode(text))


def test_every_occurrence_draws_on_its_own(model):
    encoder = pieces.Encoder(model)
    cuts = []
    for doc in range(40):
        chunks = [" international"] * 50
        one = pieces.Encoder(model, 0).encode("international").tolist()
        ids = encoder.encode(" ".join(["international"] * 50), str(doc)).tolist()
        text, cut = "", []
        for i in ids:                           # cut the ids where the words end
            text, cut = text + model.texts[i].decode(), [*cut, i]
            if text == chunks[0]:
                cuts.append(tuple(cut))
                text, cut = "", []
    assert len(cuts) == 2000 and len(set(cuts)) > 4
    steps = len(" international") - len(one)
    plain = sum(list(c) == one for c in cuts) / 2000
    assert plain >= 0.9 ** steps - 0.04


def test_remembered_agendas_equal_each_occurrence_merged_alone(model):
    rnd = random.Random(4)
    words = ["the", "international", "straße", "日本", "x▁y", "naïve", "a" * 60, "running", "tokens", "the,"]
    texts = TEXTS + [" ".join(rnd.choice(words) for _ in range(400)) for _ in range(15)]
    keys = [str(i) for i in range(len(texts))]
    for rate in (0.1, 0.4, 1.0):
        got = pieces.Encoder(model, rate, 7).encode_many(texts, keys)
        for text, key, ids in zip(texts, keys, got, strict=True):
            chunks = pieces._CHUNK.findall(" " + text) if text else []
            want = []
            for chunk, place in zip(chunks, pieces.occurrences(key, 7, len(chunks)).tolist(), strict=True):
                want += model.to_ids(pieces.merge_short(chunk, model, pieces.Dropout(chunk, rate, 7, place)))
            assert ids.tolist() == want


def test_cache_turnover_changes_nothing(model):
    small, large = pieces.Encoder(model), pieces.Encoder(model)
    small.room = 0
    for text in TEXTS * 2:
        a = small.encode(text, "z").tolist()
        small.room = 0
        assert a == large.encode(text, "z").tolist()


def test_dataframe_round_trip_and_edge_rows(spark):
    rows = [(i, t, "old") for i, t in enumerate(TEXTS)] + [(None, None, None), (None, "same", None), (None, "same", None)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("n_pieces", T.StringType())])
    out = pieces.encode(spark.createDataFrame(rows, schema))
    assert [c for c in out.columns if c == "n_pieces"] == ["n_pieces"]
    back = pieces.decode(out).collect()
    assert sorted((r["text"] or "", r["decoded"] or "") for r in back) == sorted((t or "", t or "") for _, t, _ in rows)
    assert all(r["lossless"] or r["text"] is None for r in back)
    same = [r["ids"] for r in back if r["text"] == "same"]
    assert same[0] == same[1]
    assert pieces.encode(spark.createDataFrame([], schema)).count() == 0
