"""Repeated units against a plain version; offsets point into the original text."""

import re

import pytest

from salesabc.llm import unit_dedup


def brute(rows, unit, min_words=5):
    """Units to remove: (id, start, end, kept id, kept start)."""
    places = {}
    cut = re.compile(unit_dedup.UNITS[unit])
    for key, text in rows:
        for m in cut.finditer(text or ""):
            words = re.findall(r"[^\W_]+", m.group().lower())
            if len(words) >= min_words:
                places.setdefault(tuple(words), []).append((key, m.start(), m.end()))
    out = []
    for own in places.values():
        first = min(own, key=lambda p: p[:2])
        out += [(k, s, e, first[0], first[1]) for k, s, e in own if (k, s) > first[:2]]
    return sorted(out)


def rows_of(df):
    return sorted((r["doc_id"], r["start"], r["end"], r["kept_id"], r["kept_start"]) for r in df.collect())


@pytest.mark.parametrize("unit", ["sentence", "line", "paragraph"])
def test_awkward_documents(spark, awkward, nothing, unit):
    texts = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    text = {}
    for k, t in texts:
        text.setdefault(k, t)
    removed = unit_dedup.repeated_units(awkward.where("doc_id <> 121"), unit=unit)
    assert rows_of(removed) == brute([r for r in texts if r[0] != 121], unit)
    assert unit_dedup.repeated_units(nothing, unit=unit).count() == 0
    spans = {}
    for r in removed.collect():
        spans.setdefault(r["doc_id"], set()).add((r["start"], r["end"]))
    kept = unit_dedup.remove_units(awkward.where("doc_id not in (120, 121)").select("doc_id", "text"), removed)
    for r in kept.collect():
        if text[r["doc_id"]] is None:
            assert r["text"] is None
            continue
        gone = set()
        for a, b in spans.get(r["doc_id"], ()):
            gone.update(range(a, b))
        assert r["text"] == "".join(c for i, c in enumerate(text[r["doc_id"]]) if i not in gone)
        assert r["text"] == "".join(text[r["doc_id"]][s["start"]:s["end"]] for s in r["kept_spans"])


def test_rank_decides_what_stays(spark):
    df = spark.createDataFrame([(1, 9, "Alpha beta gamma delta epsilon."), (2, 1, "alpha BETA gamma, delta epsilon!"), (3, None, "no repeat at all in here")], "doc_id long, age long, text string")
    assert [r["doc_id"] for r in unit_dedup.repeated_units(df).collect()] == [2]
    assert [r["doc_id"] for r in unit_dedup.repeated_units(df, rank=["age"]).collect()] == [1]


def words_gone(rows, min_words):
    """(id, offset of the word) of all words in a row of whole sentences, a line or a paragraph that stands earlier, by trying every row up to 3 * min_words words."""
    first, gone = {}, set()
    for key, text in sorted(rows, key=lambda r: r[0]):
        found = list(re.finditer(r"[^\W_]+", (text or "").lower()))
        stops = [w.end() for w in found]
        # A word begins a sentence if a line break or an end mark stands before it.
        begins = [i for i, w in enumerate(found) if i == 0 or re.search(r"[.!?\n]", text[stops[i - 1]:w.start()])] + [len(found)]
        runs = set()
        for a, i in enumerate(begins[:-1]):
            for j in begins[a + 1:]:
                if j - i >= min_words:
                    runs.add((i, j))
                if j - i > 3 * min_words:
                    break
        for unit in (r"[^\n]+", r"(?:[^\n]*\S[^\n]*\n?)+"):
            for m in re.finditer(unit, text or ""):
                own = [i for i, w in enumerate(found) if m.start() <= w.start() < m.end()]
                if len(own) >= min_words:
                    runs.add((own[0], own[-1] + 1))
        for i, j in sorted(runs):
            kept = first.setdefault(tuple(w.group() for w in found[i:j]), (key, i, j))
            if kept[0] != key or i >= kept[2]:
                gone.update((key, w.start()) for w in found[i:j])
    return gone


def test_query_against_brute_force(spark):
    """Lines, paragraphs and rows of whole sentences from 20 words on: the same words go, each for a place that holds its words."""
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = dict(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    words = {k: [(m.start(), m.group()) for m in re.finditer(r"[^\W_]+", (t or "").lower())] for k, t in texts.items()}
    got, gone = QUERIES["op9_substring_dedup"](spark, sf).collect(), set()
    for r in got:
        own = [w for w in words[r["doc_id"]] if r["start"] <= w[0] < r["end"]]
        gone.update((r["doc_id"], at) for at, _ in own)
        kept = [w for at, w in words[r["kept_doc_id"]] if at >= r["kept_start"]][:len(own)]
        assert [w for _, w in own] == kept and len(own) == r["words"] >= 20
        assert (r["kept_doc_id"], r["kept_start"]) < (r["doc_id"], r["start"])
    assert gone and gone == words_gone(texts.items(), 20)


def test_short_repeats_stay_and_copied_passages_go(spark):
    """Below 20 words nothing goes; a passage inside other lines, a line and a paragraph of 20 words go with their offsets."""
    passage = "One fine day we set out early. The road was long and dry. Nobody spoke for an hour or more. Then rain came."
    line = " ".join(f"w{i}" for i in range(20))
    para = "\n".join(" ".join(f"p{i}x{j}" for j in range(7)) for i in range(3))
    rows = [(1, f"Five words repeat by chance. {passage}\nFive words repeat by chance. Own tail of one."), (2, f"Head of two. {passage.upper()} Own tail of two."),
            (3, f"{line}\nelse"), (4, f"before\n{line}"), (5, f"{line} and more"), (6, f"x\n\n{para}\n\ny"), (7, f"{para}"), (8, "short. " * 9), (9, None), (10, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {}
    for r in unit_dedup.repeated_units(df, unit="passage", min_words=unit_dedup.PASSAGE_WORDS).collect():
        a, b = spans.get(r["doc_id"], (r["start"], r["end"]))
        spans[r["doc_id"]] = (min(a, r["start"]), max(b, r["end"]))
    cut = {k: dict(rows)[k][a:b].strip() for k, (a, b) in spans.items()}
    assert cut == {2: passage.upper(), 4: line, 7: para}


SHORT = "ENERAT!! ONOUTION.!! AT!! THHE!! ONRE!! OUHEAT,!! AS!! END."
PLANTED = [(1, f"{SHORT}\nOpening words of document one stand here.\nAs it was. So it is. Never more. It rains."),
           (2, f"Something else that nobody wrote before.\n{SHORT}\nA tail of its own, not repeated."),
           (3, "A new start of the line here. As it was. So it is. Never more. It rains. And then a very different end."),
           (4, f"{SHORT} {SHORT}\n{SHORT}"),
           (5, "One\nTwo two\nThree three three\n\nOnly document five has this line."), (6, "Before the planted lines of six.\n\nOne\nTwo two\nThree three three"),
           (7, "!!leading marks stay with their only line"), (8, "Go. " * 12), (None, f"{SHORT}"), (9, None), (10, "")]


def test_planted_lines_and_passages(spark):
    """Short sentences go with the line, paragraph or passage that they stand in; the earliest copy stays whole."""
    df = spark.createDataFrame(PLANTED, "doc_id long, text string")
    gone = {}
    for r in unit_dedup.repeated_units(df, unit="passage").collect():
        gone.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    left = {k: "".join(c for i, c in enumerate(t) if i not in gone.get(k, ())) for k, t in PLANTED if t is not None}
    assert left == {None: SHORT, 1: PLANTED[0][1].removeprefix(SHORT), 2: "Something else that nobody wrote before.\n\nA tail of its own, not repeated.",
                    3: "A new start of the line here. And then a very different end.", 4: "", 5: PLANTED[4][1], 6: "Before the planted lines of six.\n\n",
                    7: PLANTED[6][1], 8: "Go. Go. Go. Go. Go. ", 10: ""}


def test_spans_belong_to_id_and_text(spark):
    """Null ids, and texts that share an id, lose their own spans only; overlapping spans are cut once."""
    here, there = "Alpha beta gamma delta epsilon.", "Zeta eta theta iota kappa."
    rows = [(None, f"{here}\nNull one."), (None, f"Null two is here. {there} {here}"), (5, f"Five a of its own words. {there}"), (5, f"{here} {there}\nFive b of its own words!"), (5, f"{here} {there}\nFive b of its own words!"), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    removed = unit_dedup.repeated_units(df, unit="passage")
    got = unit_dedup.remove_units(df, removed, spans_col="removed_spans").collect()
    assert len(got) == len(rows)
    texts = sorted(r["text"] or "" for r in got)
    assert "".join(texts).count("Alpha") == 1 and "".join(texts).count("Zeta") == 1
    for own in ("Null one.", "Null two is here.", "Five a of its own words."):
        assert sum(own in t for t in texts) == 1
    assert sum("Five b of its own words!" in t for t in texts) == 2
    for r in got:
        if r["text"] is None:
            assert (r["kept_spans"], r["removed_spans"]) == ([], [])
            continue
        assert any(k == r["doc_id"] and "".join(t[s["start"]:s["end"]] for s in r["kept_spans"]) == r["text"] for k, t in rows)
        for s in r["removed_spans"]:
            assert all(s["end"] <= k["start"] or k["end"] <= s["start"] for k in r["kept_spans"])


def test_passages_query_gives_every_document(spark):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op9_repeated_passages"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        gone = {i for s in r["removed_spans"] for i in range(s["start"], s["end"])}
        assert r["text"] == "".join(c for i, c in enumerate(texts[r["doc_id"]]) if i not in gone)
        assert r["text"] == "".join(texts[r["doc_id"]][s["start"]:s["end"]] for s in r["kept_spans"])
    left = [m.group() for r in sorted(got, key=lambda r: r["doc_id"]) for m in re.finditer(r"[^\n]+", r["text"])]
    own = [tuple(re.findall(r"[^\W_]+", t.lower())) for t in left]
    own = [w for w in own if len(w) >= 5]
    assert len(own) == len(set(own))
