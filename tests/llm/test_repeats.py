from samples import documents, odd_documents, prose, rows

from paytide.llm import repeats


def sentences(seed, n, words=8):
    return "".join(prose(seed * 1000 + i, words, 10**6).capitalize() + ". " for i in range(n))


def cut(df):
    return rows(df, "doc_id", "start", "stop", "kept_doc_id")


def test_a_passage_goes_wherever_it_stands(spark):
    passage = sentences(1, 6)
    head, tail = sentences(2, 3), sentences(3, 3)
    other = sentences(4, 2)
    docs = documents(spark, [
        (1, head + passage), (2, other + passage.upper().replace(" ", "  ") + tail), (3, sentences(5, 2) + passage.replace(". ", ".\n")),
        (4, sentences(6, 9)),
    ])
    found = repeats.passages(docs).collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: r["kept_doc_id"] for r in found} == {2: 1, 3: 1}
    for r in found:
        inside = " ".join(text[r["doc_id"]][r["start"] : r["stop"]].lower().split())
        assert inside in " ".join(passage.lower().split()) and r["n_words"] == len(inside.split()) >= 40
    out = {r["doc_id"]: r for r in repeats.without_passages(docs).collect()}
    assert out[1]["text"] == text[1] and out[4]["text"] == text[4] and out[1]["removed"] is None
    (a, b), = out[2]["removed"]
    assert out[2]["text"] == text[2][:a] + text[2][b:]


def test_short_common_sentences_stay(spark):
    docs = documents(spark, [(n, "Yes. No. All rights reserved.\n" + sentences(n, 2)) for n in range(9)])
    assert repeats.passages(docs).count() == 0


def test_a_passage_without_blanks_goes(spark):
    wide = "".join(chr(0x4e00 + 7 * i) for i in range(60)) + "\n"
    few = "".join(chr(0x5e00 + 7 * i) for i in range(20)) + "\n"
    docs = documents(spark, [(n, f"{sentences(n, 2).strip()}\n{wide}") for n in range(3)]
                     + [(n, few) for n in (10, 11)])
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    cuts = {(d, text[d][a:b]) for d, a, b, _ in cut(repeats.passages(docs))}
    assert cuts == {(d, wide) for d in (1, 2)}


def test_repeats_within_a_document(spark):
    passage = sentences(9, 4)
    # A unit begins right after the one before, so with the blank in front of the sentence.
    docs = documents(spark, [(7, passage + sentences(8, 1) + passage)])
    assert cut(repeats.passages(docs)) == [(7, len(passage + sentences(8, 1)) - 1, len(2 * passage + sentences(8, 1)) - 1, 7)]


def test_offsets_are_code_points(spark):
    passage = "Où êtes-vous allés 😀 avec elle " + prose(1, 30) + "."
    docs = documents(spark, [(1, passage), (2, "😀é " * 3 + "x.\n" + passage)])
    assert cut(repeats.passages(docs)) == [(2, 12, 12 + len(passage), 1)]
    out = {r["doc_id"]: r["text"] for r in repeats.without_passages(docs).collect()}
    assert out[2] == "😀é " * 3 + "x.\n"


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert {r[0] for r in cut(repeats.passages(docs))} == {6, 8}
    out = repeats.without_passages(docs)
    assert out.columns == [*docs.columns, "removed"] and out.count() == 12
    assert repeats.passages(docs.limit(0)).count() == 0
