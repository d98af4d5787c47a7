"""License scans against a search of every place, and odd rows."""
import re

from phenolens.llm import license_scan as ls
from phenolens.llm import queries

from conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base_places(words):
    out = []
    for t in ls.BASE:
        own = t.text.split()
        out += [(i, t.label) for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]
    return sorted(out)


def test_query_against_every_place(spark):
    """Base places from the words alone; notices by trying all templates at all places with the same rules."""
    rows = {r["doc_id"]: r for r in queries.QUERIES["op12_license_scans"](spark, SF["0.01"]).collect()}
    docs = queries.documents(spark, SF["0.01"]).collect()
    words = {d["doc_id"]: words_of(d["text"]) for d in docs}
    own = [[w.encode() for w in words_of(t.text)] for t in ls.NOTICES]
    frequency = {}
    for w in {w for ws in own for w in ws} | {w.encode() for t in ls.BASE for w in t.text.split()}:
        frequency[w] = sum(w.decode() in set(ws) for ws in words.values())
    index = ls.RareWordIndex(ls.BASE + ls.NOTICES, sum(bool(w) for w in words.values()), frequency)
    assert len(rows) == len(docs) and sum(r["n_base"] for r in rows.values()) > 10
    for i, r in rows.items():
        places = base_places(words[i])
        assert (r["n_words"], r["n_base"]) == (len(words[i]), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({p[1] for p in places}))
        encoded, labels, best = [w.encode() for w in words[i]], {p[1] for p in places}, float(bool(places))
        for t, template in enumerate(ls.NOTICES, len(ls.BASE)):
            if not all(k in encoded for phrase in template.keys for k in (w.encode() for w in words_of(phrase))):
                continue
            for start in range(-len(index.words[t]), len(encoded)):
                posted = sum(weight for w, ps in index.postings.items() for (u, at, weight) in ps
                             if u == t and 0 <= start + at < len(encoded) and encoded[start + at] == w)
                agreement = index._agreement(encoded, t, start)
                if posted >= index.needed[t] and agreement >= ls.AGREE:
                    labels.add(template.label)
                    best = max(best, agreement)
        assert r["labels"] == ",".join(sorted(labels)) and abs(r["score"] - best) < 1e-9


def test_notices_and_odd_rows(spark, docs_of):
    mit = next(t.text for t in ls.NOTICES if t.label == "mit" and len(t.text) > 100)
    docs = [(1, "x " + mit.upper() + " y"), (2, mit.replace("documentation files", "docs")), (3, "permission to play mit"),
            (4, None), (5, ""), (None, "CC BY! cc-by\ncc by"), (6, "license " * 50_000 + "Released under the MIT License"),
            (7, "Licensed under CC BY-NC 4.0."), (7, "Licensed under CC BY-NC 4.0."), (8, "ccby allrightsreserved"),
            (9, "the GNU General Public License, version 3, all rights reserved"), (10, "é cc by é")]
    out = ls.summarise(ls.scan(docs_of(docs))).collect()
    assert len(out) == len(docs)
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in out}
    assert got[1][1:] == (0, None, None, "", "mit") and got[2][5] == "mit" and got[3][5] == ""
    assert got[4] == got[5] == (0, 0, None, None, "", "")
    assert got[None] == (6, 3, 0, 4, "cc-by", "cc-by") and got[6][5] == "mit" and got[8][5] == ""
    assert got[7] == (7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0") and got[10][:4] == (4, 1, 1, 1)
    assert got[9][4:] == ("gpl,reserved", "gpl,gpl-3.0,reserved")
    scores = {r["doc_id"]: r["score"] for r in out}
    assert scores[4] == 0 and scores[9] == 1 and ls.AGREE <= scores[2] < 1
    found = {r["doc_id"]: r["matches"] for r in ls.scan(docs_of(docs)).collect()}
    assert [(m["label"], m["start"], m["length"]) for m in found[1]] == [("mit", 1, len(words_of(mit)))]
    assert ls.scan(docs_of([])).collect() == []
    none = ls.scan(docs_of(docs), templates=()).collect()
    assert len(none) == len(docs) and not any(r["matches"] for r in none)
