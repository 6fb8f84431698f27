import hashlib
import random
import tracemalloc

import numpy as np
from samples import documents, odd_documents
from tokenizers import Tokenizer

from paytide.llm import bpe, tables
from paytide.llm.queries import REGISTRY, TOKENIZER
from paytide.llm.tables import table

TRICKY = [
    "", " ", "\n", "it's I'LL don't", "ΣΑΣ Σ İstanbul", "a<|endoftext|>B <|startoftext|>", "x\x1cy\x85z", "3½ é ﬁ Ǆ",
    "aaaaaaaaaaaaaaaa", "ababababab", "中文字", "\U0001f600\U0001f600", "é é", "a" * 500,
]


def texts():
    rnd = random.Random(7)
    signs = "aaabbcdeinthre'’.,!?019 \n\tßéΣσςİı中😀̀<|>/w"
    return TRICKY + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 90))) for _ in range(3_000)] + [
        "".join(rnd.choice("aehtinro") for _ in range(rnd.randint(0, 200))) for _ in range(500)
    ]


def test_ids_and_text_are_the_library_s():
    library, own = Tokenizer.from_file(TOKENIZER), bpe.tokenizer(TOKENIZER)
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_emptying_the_word_memory_changes_nothing(monkeypatch):
    own = bpe.WordBpe(TOKENIZER)
    want = [own.encode(t) for t in texts()[:200]]
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    own.words.clear()
    assert [own.encode(t) for t in texts()[:200]] == want


def test_query_over_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(TOKENIZER)
    found = {r["doc_id"]: r for r in REGISTRY["op9_bpe_roundtrip"](spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids
        r = found[doc["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    out = bpe.encode(odd_documents(spark), TOKENIZER).collect()
    assert len(out) == 12
    assert all(r["ids"] == [] and r["decoded"] == "" for r in out if r["doc_id"] in (1, 2, 3))
    assert bpe.encode_digests(documents(spark, []), TOKENIZER).count() == 0


def test_memory_of_words_and_borders_is_small():
    """Several workers share an executor: two full generations of words and all borders, about 20 and 10 MB."""
    rnd, own = random.Random(3), bpe.WordBpe(TOKENIZER)
    tracemalloc.start()
    for _ in range(2_000):
        own.ids(" ".join("".join(rnd.choices("etaoinshr", k=rnd.randint(4, 12))) for _ in range(100)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(own.words) + len(own.older) > 100_000 and len(own.borders) <= bpe.BORDERS_KEPT
    assert held < 40 << 20
    own.forget()
    assert not own.words and not own.older and not own.borders


def test_ids_are_held_packed():
    ids = [r[1] for r in bpe._encode_rows(iter([(1, "some text, 1 2 3"), (2, None)]), TOKENIZER)]
    assert [i.dtype for i in ids] == [np.int32] * 2 and tables.bytes_of(ids[0]) == 4 * len(ids[0]) and not len(ids[1])


def test_long_texts_are_joined_in_blocks(monkeypatch):
    own = bpe.tokenizer(TOKENIZER)
    want = [own.decode(own.encode(t)) for t in TRICKY]
    monkeypatch.setattr(bpe, "JOINED_AT_ONCE", 2)
    assert [own.decode(own.encode(t)) for t in TRICKY] == want


def test_new_words_are_encoded_together(monkeypatch):
    """A call in Python per new word took most of the time."""
    library = Tokenizer.from_file(TOKENIZER)
    rows = [(i, t) for i, t in enumerate(t for t in texts() if max(map(len, bpe.words(t)), default=0) <= bpe.LONG_WORD)]
    calls = []
    alone = bpe.WordBpe.word_ids
    monkeypatch.setattr(bpe.WordBpe, "word_ids", lambda own, word: calls.append(word) or alone(own, word))
    bpe.tokenizer.cache_clear()
    found = list(bpe._digest_rows(iter(rows), TOKENIZER))
    assert len(rows) > 2_000 and not calls
    for (doc_id, text), row in zip(rows, found, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(part.encode()).hexdigest() for part in (" ".join(map(str, ids)), decoded)]
        assert row == (doc_id, len(ids), *digests), text


def test_together_or_alone_is_the_same(monkeypatch):
    own = bpe.WordBpe(TOKENIZER)
    new = sorted({w for t in texts() for w in bpe.words(t)})
    alone = [bpe.packed(own.word_ids("".join(own.bytes[b] for b in w.encode()))) for w in new]
    assert own.new_ids(new) == alone
    # Next to nothing is remembered, and little is done at once.
    few = {"JUDGED_BITS": 1, "WORDS_KEPT": 5, "WORDS_AT_ONCE": 3, "TEXT_AT_ONCE": 400, "NEW_AT_ONCE": 9}
    for name, value in few.items():
        monkeypatch.setattr(bpe, name, value)
    little = bpe.WordBpe(TOKENIZER)
    assert little.new_ids(new) == alone
    want = [own.encode(t) for t in texts()[:300]]
    assert [ids.tolist() for _, ids in little.rows_ids(iter(enumerate(texts()[:300])))] == want


def test_a_word_written_as_a_special_token_is_not_one():
    own = bpe.WordBpe(TOKENIZER)
    own.special["\ncat"] = bpe.packed([7])
    own.split_special = bpe.re.compile("(cat)")
    assert own.encode("cat") == [7] and own.encode("Cat") == bpe.WordBpe(TOKENIZER).encode("cat")
