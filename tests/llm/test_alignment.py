"""Token alignment against a version that walks over the decoded bytes of both tokenizers."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chunkwright.llm import alignment
from chunkwright.llm.pretokens import read_vocabulary
from chunkwright.llm.queries import QUERIES, piece_model_path, vocabulary_path

SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "  ", "a  b\tc\n d <|endoftext|> <s> <0x41> <unk>", "é漢漢\U0001f642 ﬁ Ａ xy\x00 \x85 \xa0c \U0001f642\U0001f642",
    "  lead and trail  ", "word " * 3000, "漢字" * 500, " \n x", " x", "x ", "a▁b here", "here a▁b", "▁", "plain words only", "\t\t  x\r\n  y",
]


@pytest.fixture(scope="module")
def aligner():
    with open(piece_model_path(), "rb") as file:
        return alignment.Aligner(read_vocabulary(vocabulary_path()), file.read())


@pytest.fixture(scope="module")
def plain(aligner):
    a = Tokenizer.from_file(vocabulary_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())

    def align(text):
        """Numbers of tokens and groups, digest, and the id pairs of all links."""
        if not text:
            return 0, 0, 0, "", []
        whole = f" {text}".encode()
        sides = []
        for ids, table in ((a.encode(f" {text}", add_special_tokens=False).ids, aligner.a_bytes), (b.encode(text), aligner.b_bytes)):
            if b"".join(table[i] for i in ids) != whole:
                return 0, 0, 0, "", []
            sides.append((ids, np.cumsum([len(table[i]) for i in ids]).tolist()))
        (ids_a, ends_a), (ids_b, ends_b) = sides
        groups, links, x, y = [], [], 0, 0
        for cut in sorted({*ends_a} & {*ends_b}):
            x1, y1 = ends_a.index(cut, x) + 1, ends_b.index(cut, y) + 1
            groups.append(",".join(map(str, ids_a[x:x1])) + "|" + ",".join(map(str, ids_b[y:y1])))
            for i in range(x, x1):
                for j in range(y, y1):
                    if (ends_b[j - 1] if j else 0) < ends_a[i] and (ends_a[i - 1] if i else 0) < ends_b[j]:
                        links.append((ids_a[i], ids_b[j]))
            x, y = x1, y1
        return len(ids_a), len(ids_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links

    return align


def plain_rows(plain, rows):
    found = [(key, *plain(text)) for key, text in rows]
    count = Counter(pair for row in found for pair in row[5])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            (key, n_a, n_b, n_groups, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), told)
            for key, n_a, n_b, n_groups, told, links in found
        ),
        key=repr,
    )


def test_query_equals_the_plain_version(spark, plain):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_token_alignment"](spark, SF)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_rows(plain, rows)


@pytest.mark.parametrize("most", [alignment.PIECES, 3])
def test_texts_of_all_kinds(aligner, plain, monkeypatch, most):
    monkeypatch.setattr(alignment, "PIECES", most)
    store = alignment.Store(aligner)
    size = len(aligner.a_bytes)
    for text in TEXTS * 2:
        (counts, told, pairs, times), want = next(store.align([text])), plain(text)
        assert (*counts.tolist(), told) == (*want[:3], len(want[4]), want[3]), text
        assert dict(zip(pairs.tolist(), times.tolist())) == Counter(b * size + a for a, b in want[4]), text


def test_ends_are_those_of_the_decoded_bytes(aligner):
    parts = [f" {t}" for t in TEXTS if t and "▁" not in t and t != " "]
    raw = [p.encode() for p in parts]
    total = np.cumsum([len(r) for r in raw])
    for spans, lengths in ((aligner.a_spans(parts, raw), aligner.a_lengths), (aligner.b_spans(parts, raw), aligner.b_lengths)):
        assert spans.whole.all()
        assert (spans.ends == np.cumsum(lengths[spans.ids])).all() and spans.ends[-1] == total[-1]


def test_odd_rows_and_both_joins(spark, oddities, nothing, plain):
    rows = [(r.doc_id, r.text) for r in oddities.select("doc_id", "text").collect()]
    want = plain_rows(plain, rows)
    for most in (0, alignment.BROADCAST_PAIRS):
        got = alignment.alignment_digests(oddities, vocabulary_path(), piece_model_path(), most)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    aligned = alignment.align(oddities, vocabulary_path(), piece_model_path())
    assert aligned.columns == [*oddities.columns, "alignment"] and aligned.count() == oddities.count()
    assert alignment.alignment_digests(nothing, vocabulary_path(), piece_model_path()).count() == 0
