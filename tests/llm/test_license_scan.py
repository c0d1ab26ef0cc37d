"""Licence templates against regular expressions, plain searches and SQL."""

import random
import re

import pytest

from areaweave.llm import license_scan as ls
from areaweave.llm.oracles import ORACLES
from areaweave.llm.queries import op11_license_scan
from workloads.check import database, differences

MARKUP = re.compile(r"<<.*?>>", re.DOTALL)


def original(text):
    """A template's wording as published: optional regions stay, replaceable ones show their original."""
    shown = re.sub(r'<<var;[^>]*original="([^"]*)"[^>]*>>', r"\1", text)
    return MARKUP.sub("", shown)


@pytest.mark.parametrize("label", ls.TEMPLATES)
def test_published_wording_is_found_and_a_changed_word_is_not(label):
    template = ls.TEMPLATES[label]
    automaton = ls.compile_template(label, template)
    wording = original(template)
    found = [m for m in ls.scan_text(f"First lines here.\n{wording}\nMore text.", [], [automaton])[2]]
    assert found and found[0][2] - found[0][1] >= len(automaton.mandatory)
    words = ls.words_of(wording)
    for lost in set(automaton.mandatory):
        if words.count(lost) == 1:
            at = words.index(lost)
            changed = b" ".join([*words[:at], b"zzz", *words[at + 1:]]).decode()
            assert ls.scan_text(changed, [], [automaton])[2] == []


def test_markup():
    template = 'a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;name="x";original="o";match=".+">> d'
    automaton = ls.compile_template("t", template)
    def spans(text, **kw):
        return ls.scan_text(text, [], [automaton], **kw)[2]
    assert spans("a x d") == [("t", 0, 3)] and spans("a d") == [] and spans("a b c x y z d") == [("t", 0, 7)]
    assert spans("z a b d d") == [("t", 1, 5)]
    assert automaton.mandatory == [b"a", b"d"]
    for size in (1, 2, 3, 5):
        assert spans("z, a b -- c x y; z d!", size=size) == [("t", 1, 8)]
    for bad in ("a <<endOptional>> b", "<<beginOptional>> a", "<<other>> a", '<<var;name="x">> a', '<<var;match=".*">> a', ""):
        with pytest.raises(ValueError):
            ls.compile_template("bad", bad)


def test_automata_as_regular_expressions():
    rng = random.Random(3)
    items = ["a", "b", "c", "d", "<<beginOptional>>a b<<endOptional>>", '<<var;name="n";match=".*">>', '<<var;name="n";match=".+">>',
             '<<var;name="n";match="a|b c|d">>', "<<beginOptional>>c <<beginOptional>>d<<endOptional>><<endOptional>>"]
    for _ in range(300):
        template = " ".join([rng.choice("abcd"), *[rng.choice(items) for _ in range(rng.randrange(5))], rng.choice("abcd")])
        automaton, pattern = ls.compile_template("t", template), re.compile(" " + ls.as_regex(ls.read_template(template)))
        for _ in range(20):
            text = " ".join(rng.choice("abcd") for _ in range(rng.randrange(12)))
            assert bool(ls.scan_text(text, [], [automaton])[2]) == bool(pattern.search(f" {text} ")), (template, text)


def plain(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = {label: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()] for p, label in ls.PHRASES}
    places = sorted(i for found in at.values() for i in found)
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None,
            ",".join(sorted(label for label, found in at.items() if found)))


def test_edges_and_query(spark, sf, tmp_path):
    mit = original(ls.TEMPLATES["MIT"])
    texts = [None, "", " .\n", "MIT License", "mit license mit license apache LICENSE", "GNU General Public License, version 3 or later",
             "Mİt lİcense ſ K license", mit, mit.upper() + " " + mit, "x" * 70_000, "permission is hereby " * 30_000,
             "word " * 300_000 + "released under the MIT license", "licensed under cc by-nc 4.0", mit.replace("hereby", "not")]
    rows = [(None if i == 3 else i // 2, t, "clash", "clash") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words string, matches string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_license_scan(spark, str(tmp_path))
    key = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((tuple(r[c] for c in key) for r in got.collect()), key=repr) == sorted(((r[0], *plain(r[1])) for r in rows), key=repr)
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert differences(got, con, ORACLES["op11_license_scan"]) == []
    labels = {(r.doc_id, r.n_words): r.labels for r in got.collect()}
    assert "MIT" in labels[3, len(ls.words_of(mit))].split(",")
    assert ls.scan(frame.limit(0)).count() == 0
    assert differences(op11_license_scan(spark, sf), database(sf), ORACLES["op11_license_scan"]) == []


def test_own_templates(spark):
    frame = spark.createDataFrame([(1, "You may share this, as you like."), (2, "You may not share this")], "doc_id long, text string")
    got = {r.doc_id: r for r in ls.scan(frame, {"share": 'you may share <<var;name="what";match=".+">> as you like'}, ()).collect()}
    assert [(m.label, m.start, m.end) for m in got[1].matches] == [("share", 0, 7)] and got[1].score == 6 / 7
    assert got[2].matches == [] and got[2].score == 0 and got[2].n_base == 0
