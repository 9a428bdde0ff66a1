"""Alignment against a brute-force version with the libraries' own encoders."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fairstream.llm import alignment
from fairstream.llm import queries as llm
from fairstream.sources.tables import read_table
from tests.conftest import SF_SMALL

ROW = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("uid", T.StringType()), T.StructField("pairs", T.StringType()),
                    T.StructField("seq", T.StringType())])
WORDS = ["the", "naïve", "co-operation", "123456", "don't", "Straße", "日本語", "emoji😀", "a", "I'll", "x_y", "...", "\n",
         "  ", "\t", "</s>", "<|endoftext|>", "supercalifragilistic", "▁"]


def models():
    byte = Tokenizer.from_file(alignment.BYTE_MODEL)
    byte.encode_special_tokens = True
    return byte, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)


def brute(texts):
    """The contract's columns of each text, from token lists."""
    byte, piece = models()
    letters = alignment._byte_letters()
    out, links = [], []
    for text in texts:
        a = byte.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in byte.id_to_token(i)) for i in a]
        raw_b = [bytes([int(piece.id_to_piece(i)[3:5], 16)]) if piece.is_byte(i)
                 else piece.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            a, b, raw_a, raw_b = [], [], [], []
        def ends(raw):
            at, got = 0, []
            for r in raw:
                at += len(r)
                got.append(at)
            return got
        ea, eb = ends(raw_a), ends(raw_b)
        cuts = sorted(set(ea) & set(eb))
        at = dict(zip(eb, b))
        mine = [(x, at[e]) for x, e in zip(a, ea) if e in at]
        groups, lo = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, e in zip(a, ea) if lo < e <= c) + "|"
                          + ",".join(str(i) for i, e in zip(b, eb) if lo < e <= c))
            lo = c
        links.append(mine)
        out.append([len(a), len(b), len(groups), ";".join(groups)])
    counts = Counter(x for mine in links for x in mine)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [(n_a, n_b, n, len(mine), sum(counts[x] == most[x[1]] for x in mine), sum(counts[x] for x in mine),
             hashlib.sha256(g.encode()).hexdigest() if n_a else "")
            for (n_a, n_b, n, g), mine in zip(out, links)]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def made():
    rnd = random.Random(4)
    texts = [None, "", " ", "a", " a  b ", "\n\n", "x" * 3000, "日本語" * 300, "▁foo bar", "<s> </s> <0x0A>", "a b\x00c"]
    texts += [" ".join(rnd.choice(WORDS) for _ in range(n)) for n in (3, 40, 200, 700, 900)]
    texts += [" ".join(rnd.choice(WORDS[:-1]) for _ in range(n)) for n in (60, 700, 1500)]
    texts += ["the same words " * 400, "the same words " * 400, texts[13]]
    return texts


@pytest.mark.parametrize("sizes", [{}, {"long_bytes": 300, "section_chars": 90, "range_bytes": 40, "pair_block": 70},
                                   {"long_bytes": 0, "section_chars": 25, "range_bytes": 7}])
def test_alignment_equals_brute_force(spark, sizes):
    texts = made()
    frame = spark.createDataFrame([(k if k % 5 else None, t, "x", "y", "z") for k, t in enumerate(texts)], ROW)
    got = alignment.align(frame.repartition(3), **sizes).collect()
    want = [(k if k % 5 else None, *row) for k, row in enumerate(brute(texts))]
    assert sorted(((r["doc_id"], *[r[c] for c in COLUMNS]) for r in got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], ROW)).count() == 0


def fragment():
    open_part = st.tuples(st.tuples(*[st.integers(0, 9)] * 1) | st.just(()), st.tuples(st.integers(0, 9)) | st.just(()))
    closed = st.lists(open_part, max_size=2).map(tuple)
    whole = st.builds(alignment.Fragment, open_part, closed, open_part, st.just(True))
    return whole | st.builds(lambda p: alignment.Fragment(p), open_part)


@settings(max_examples=200, deadline=None)
@given(fragment(), fragment(), fragment())
def test_composition_is_associative_with_an_identity(x, y, z):
    one = alignment.Fragment()
    assert alignment.compose(alignment.compose(x, y), z) == alignment.compose(x, alignment.compose(y, z))
    assert alignment.compose(one, x) == x == alignment.compose(x, one)


def test_sections_cut_where_neither_model_has_a_token_across():
    byte, piece = models()
    rnd = random.Random(8)
    for k in range(60):
        text = "".join(rnd.choice(WORDS + [" ", " ", "  ", "\n", " the", "é "]) + rnd.choice(["", " "]) for _ in range(200))
        text = text.replace("▁", "")
        parts = list(alignment.cut_sections(text, k))
        assert " ".join(p for _, p in parts) == text
        raw = (" " + text).encode()
        assert all(raw[at:at + 1 + len(p.encode())] == b" " + p.encode() for at, p in parts)
        ids = [byte.encode(" " + p, add_special_tokens=False).ids for _, p in parts]
        assert sum(ids, []) == byte.encode(" " + text, add_special_tokens=False).ids
        assert sum(piece.encode([p for _, p in parts]), []) == piece.encode(text)


def test_byte_ids_are_those_of_the_model_file():
    t = alignment.Tokenizers(open(alignment.BYTE_MODEL, "rb").read(), open(alignment.PIECE_MODEL, "rb").read())
    byte, _ = models()
    rnd = random.Random(5)
    texts = ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(1, 0x3000)])) for _ in range(80))
             for _ in range(300)] + ["z" * 20000, " " * 20000, "!?" * 9000, "\n" * 9000, "a" + " \n" * 700_000 + "b"]
    a, _, _ = t.encode(texts)
    assert [x.tolist() for x in a] == [e.ids for e in byte.encode_batch([" " + x for x in texts], add_special_tokens=False)]


def test_query(spark):
    rows = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in llm.op13_cross_tokenizer_alignment(spark, SF_SMALL).collect()}
    assert got == dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows])))
