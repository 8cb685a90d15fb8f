import random

import pyarrow as pa
from helpers import LETTER_WORD, LOWER, corpus, prose, with_clashes

from quayside.llm import repeats as R


def units(text):
    out, cur = [], []
    found = list(LETTER_WORD.finditer(text))
    for i, m in enumerate(found):
        if not cur:
            start = m.start()
        cur.append(m.group().translate(LOWER))
        then = found[i + 1].start() if i + 1 < len(found) else len(text)
        gap = text[m.end():then]
        if i + 1 == len(found) or "\n" in gap or gap[:1] in tuple(".!?"):
            out.append([start, then, tuple(cur)])
            cur = []
    if out:
        out[0][0] = 0
    return out


def brute(rows):
    """{row number: spans} by a scan in rank order."""
    last = 1 << 70
    first = {}
    for d, t in rows:
        for _, _, w in units(t or ""):
            first[w] = min(first.get(w, last), last if d is None else d)
    out = {}
    for i, (d, t) in enumerate(rows):
        us, own, flags = units(t or ""), set(), []
        me = last if d is None else d
        for _, _, w in us:
            if len(w) < R.UNIT_WORDS:
                flags.append(None)
                continue
            flags.append((first[w],) if first[w] < me else (me,) if w in own else False)
            own.add(w)
        spans, k = [], 0
        while k < len(us):
            if not flags[k]:
                k += 1
                continue
            end = j = k
            while j + 1 < len(us) and flags[j + 1] is not False:
                j += 1
                end = j if flags[j] else end
            n = sum(len(u[2]) for u in us[k:end + 1])
            if n >= R.CUT_WORDS:
                keeper = flags[k][0]
                spans.append((us[k][0], us[end][1], n, None if keeper == last else keeper))
            k = end + 1
        out[i] = spans
    return out


def rows():
    rng = random.Random(8)
    shared = prose(rng, 60)
    line = "All of this line stands in many of the documents here"
    out = corpus() + [(500 + i, prose(rng, 20) + "\n" + line + "\n" + prose(rng, 20)) for i in range(8)]
    out += [(600, f"{line}\n{line}\n{line}\né {shared} ü"), (601, f"Ünter {shared}"), (602, shared.upper()), (603, "Yes. No. " + line + ". Yes."), (604, line + "\r\n" + "short one")]
    return out


def test_spans_match_brute_force(spark):
    data = rows()
    want = brute(data)
    keyed = [(i, d, t) for i, (d, t) in enumerate(data)]
    docs = spark.createDataFrame(keyed, "key long, doc_id long, text string").repartition(3)
    got = {r["key"]: r for r in R.remove_repeats(docs).collect()}
    assert len(got) == len(data)
    for i, (_, t) in enumerate(data):
        spans = [(s["start"], s["stop"], s["n_words"], s["kept_doc_id"]) for s in got[i]["removed"]]
        assert spans == want[i]
        left, at = "", 0
        for start, stop, _, _ in spans:
            left, at = left + t[at:start], stop
        assert "".join((left + (t or "")[at:]).split()) == "".join((got[i]["text"] or "").split())
        if not spans:
            assert got[i]["text"] == t
    assert want[len(data) - 5] and want[len(data) - 3]


def test_a_passage_stays_once(spark):
    rng = random.Random(9)
    passage = prose(rng, 80)
    docs = [(i, prose(rng, 40) + (". " if i % 2 else " ") + passage + " " + prose(rng, 40)) for i in range(30)]
    got = {r["doc_id"]: r["text"] for r in R.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    middle = passage.split(". ")[3]
    assert [d for d, t in got.items() if middle in t] == [0]


def test_columns_and_empty_tables(spark):
    docs = with_clashes(spark.createDataFrame([(1, "a", "x"), (None, None, "y")], "doc_id long, text string, removed string"))
    got = R.remove_repeats(docs)
    assert got.columns == [c for c in docs.columns if c != "removed"] + ["removed"]
    assert sorted(r["node"] for r in got.collect()) == ["own node"] * 2
    assert R.remove_repeats(docs.limit(0)).collect() == []


def test_segments_of_long_words(monkeypatch):
    from quayside.llm import wordhash

    texts = pa.array(["a" * 50 + " b", None, "", "é" * 30, "x " * 40 + "y", "a" * 50])
    whole = wordhash.hash_words(texts, wordhash.LETTERS)
    monkeypatch.setattr(wordhash, "SEGMENT", 7)
    parts = wordhash.hash_words(texts, wordhash.LETTERS)
    assert (whole.hash == parts.hash).all() and (whole.start == parts.start).all() and (whole.first == parts.first).all()
    assert whole.hash[0] == whole.hash[-1]


def test_passages_of_short_lines_go(spark):
    rng = random.Random(10)
    menu = "\n".join(f"dish{i}q {i} euro" for i in range(40))
    refrain = "\n".join(["la la la"] * 30)
    mixed = "\n".join(f"item{i}z costs" + " rather much in the end" * (i % 4 == 0) for i in range(24))
    docs = [(i, f"{prose(rng, 30)}\n{p}\n{prose(rng, 30)}") for i, p in enumerate([menu, menu, mixed, mixed])] + [(9, refrain)]
    got = {r["doc_id"]: r for r in R.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, p in ((0, menu), (2, mixed)):
        assert got[i]["text"] == docs[i][1]
        assert [s["kept_doc_id"] for s in got[i + 1]["removed"]] == [i]
        (s,) = got[i + 1]["removed"]
        assert docs[i + 1][1][s["start"]:s["stop"]].strip() == p
    assert got[9]["text"].split() == ["la"] * 12        # the first of its windows stays whole


def test_passages_without_blanks_go(spark):
    rng = random.Random(11)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
    lines = "\n".join(han(25) for _ in range(12))
    sentences = "".join(han(rng.randrange(5, 30)) + rng.choice("。！？") for _ in range(12))
    docs = [(0, lines), (1, f"{han(30)}\n{lines}\n{han(30)}"), (2, f"{han(20)}。{sentences}{han(20)}。"), (3, f"{han(40)}。{sentences}{han(40)}。")]
    got = {r["doc_id"]: r["text"] for r in R.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0] == docs[0][1] and got[2] == docs[2][1]
    assert not any(x in got[1] for x in lines.split("\n"))
    # A short sentence at an end has no neighbour that is short, and may stay.
    assert len(got[3]) <= 82 + 60 and sentences[30:-30] not in got[3]


def test_rows_of_one_id_hold_a_passage_once(spark):
    rng = random.Random(12)
    passage = prose(rng, 60)
    for i in (None, 7):
        docs = [(i, f"{prose(rng, 27)}\n{passage}\n{prose(rng, 27)}") for _ in range(5)] + [(i, passage)] * 3 + [(i, None), (i, None), (i, "")]
        got = R.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
        middle = passage.split(". ")[3]
        assert len(got) == len(docs) and sum(middle in (r["text"] or "") for r in got) == 1
        assert {s["kept_doc_id"] for r in got for s in r["removed"]} == {i}


def test_a_sentence_that_stands_elsewhere_stays(spark):
    rng = random.Random(13)
    common = "This page was last changed on a day that nobody wrote down anywhere at all"
    passage = prose(rng, 60)
    docs = [(i, f"{prose(rng, 27)}\n{common}.\n{prose(rng, 27)}") for i in range(6)] + [(10 + i, f"{prose(rng, 27)}\n{passage}\n{prose(rng, 27)}") for i in range(3)]
    got = {r["doc_id"]: r for r in R.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i]["text"] for i in range(6)] == [t for _, t in docs[:6]]
    assert [len(got[i]["removed"]) for i in (10, 11, 12)] == [0, 1, 1]
