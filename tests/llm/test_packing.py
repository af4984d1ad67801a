import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from marquee.llm.packing import END_ID, pack, with_digests
from marquee.llm.common import tokenizer_file

FILE = tokenizer_file("word_bpe_49k.json")


@pytest.mark.parametrize("name", ["hard_docs", "some_docs"])
def test_pieces_are_the_documents(name, request):
    docs = request.getfixturevalue(name)
    tokenizer = Tokenizer.from_file(FILE)
    expected = sorted(((r["doc_id"] is None, r["doc_id"] or 0), tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [END_ID]) for r in docs.collect())
    pieces = pack(docs, FILE, 256).collect()
    by_sequence, stream = defaultdict(list), []
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        by_sequence[p["sequence_id"]].append(p)
        stream.append(p)
    for k, parts in by_sequence.items():
        at = 0
        for p in parts:
            assert p["offset"] == at
            at += len(p["ids"]) // 4
        assert at == 256 or k == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    found, open_ids = [], []
    for p in stream:  # a document's pieces follow one another in the stream
        assert p["start"] == len(open_ids)
        open_ids += np.frombuffer(p["ids"], "<u4").tolist()
        if len(open_ids) == p["doc_tokens"]:
            found.append(((p["doc_id"] is None, p["doc_id"] or 0), open_ids))
            open_ids = []
    assert not open_ids and sorted(found) == expected


def test_digests(some_docs):
    pieces = pack(some_docs, FILE, 2048)
    digests = {(r["doc_id"], r["start"]): r for r in with_digests(pieces).collect()}
    for p in pieces.collect():
        d = digests[p["doc_id"], p["start"]]
        assert d["ids_crc32"] == zlib.crc32(bytes(p["ids"])) and d["length"] * 4 == len(p["ids"])


def test_empty(no_docs):
    assert with_digests(pack(no_docs, FILE)).collect() == []


def test_parts_keep_the_ids(some_docs):
    import pyarrow as pa

    from marquee.llm.packing import _Encoder

    tokenizer = Tokenizer.from_file(FILE)
    texts = ["don't it's 'S we'll can't, (can't) ,'s", "a,b;c... d--e f_g h1 1h 12,3", "J̌ ǰ Ǩ Å Å Å ≠ a≠", "<|endoftext|> x<|startoftext|>y <|nope|> a<b", "\x1c a\x1fb \x00, \x7f.", "É,é É. …, a…b  x y 　z", "Σ ΑΣ ΑΣ, İI ı ǅ ﬁ", "ALL CAPS!! All Caps??", "á, é ́x ,́ .́"]
    texts += [r["text"] or "" for r in some_docs.collect()]
    encoder = _Encoder(FILE)
    for _ in range(2):
        got = [x.tolist() for x in encoder.encode(pa.array(texts))]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
