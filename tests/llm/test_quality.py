import duckdb

from tidegate.llm import quality
from tidegate.llm.queries import ORACLE
from tidegate.llm.quality import is_item, judge, line_fails, repeated_words

PROSE = " ".join(f"word{k}" for k in range(60)) + "."


def test_lines():
    assert line_fails("Home | News | About | Login") and not line_fails("a | b")
    assert line_fails("the### to%%% of&&& in$$$") and not line_fails("Prices rose by 5% in the last year.")
    assert line_fails("STOP!! IT!! NOW!! PLEASE") and not line_fails("Stop it now, please!")
    assert line_fails("All Rights Reserved.") and not line_fails("He had all rights.")


def test_separators_in_any_language():
    assert line_fails("Startseite · Über uns · Impressum") and line_fails("Accueil › Produits › Chaussures")
    assert line_fails("Home / About us / Contact") and line_fails("Terms • Contact • Imprint")
    assert line_fails("ホーム » 製品 » 会社 »") and not line_fails("« Bonjour » « Salut » dit-il.")
    assert not line_fails("He read and/or wrote in 1997 / 1998, as the record of the town tells.")


def test_punctuation_share_and_word_lists():
    assert line_fails("--- === --- ===") and line_fails("});") and line_fails("$(x).y({z: 1});")
    assert not line_fails("\"Well,\" she said - \"so it is.\"") and not line_fails("यह एक वाक्य है।")
    tags = " ".join(f"shoes{k}" for k in range(40))
    assert line_fails(tags) and not line_fails(tags + ".") and not line_fails(tags[: tags.rindex(" ")]) and not line_fails(tags + "。")


def test_line_ends():
    assert line_fails("The mayor of the town told reporters on Monday that...") and line_fails("“Er sagte gestern, dass …”")
    assert not line_fails("Well ...") and not line_fails("The mayor told it on Monday.")
    assert is_item("Contact us now", 3) and not is_item("Stop.", 1) and not is_item('He "left."', 2) and is_item('"', 1)


def verdict(text):
    return dict(zip([p.split()[0] for p in quality.RESULT.split(", ")], judge(text, 50, 50, 50)))


def test_menus_lists_headings_verse():
    menu = "\n".join(["Home", "News", "", "About us", "Kontakt", "会社概要"])
    found = verdict(menu + "\n" + PROSE + "\n" + menu)
    assert found["clean_text"] == "\n" + PROSE + "\n" and found["n_removed_lines"] == 10 and found["n_lost_words"] == 12 and found["kept"]
    assert verdict("\n".join(f"Entry number{k}" for k in range(40)))["kept"] is False  # one item a line, nothing else
    four = "\n".join(["Home", "News", "About us", "Kontakt"])
    assert verdict(four + "\n" + PROSE)["n_removed_lines"] == 0
    assert verdict(four + "\nIt ends.\n" + four + "\n" + PROSE)["n_removed_lines"] == 0
    headings = "\n".join(f"Chapter {k}\n\nWith text{k} that{k} tells{k} something about it.\n" for k in range(12))
    shopping = "\n".join(f"- take {k} spoons of{k} flour or{k} sugar{k}" for k in range(12))
    verse = "\n".join(f"the evening{k} comes over hill{k} and over meadow{k}" for k in range(12))
    for text in (headings, shopping, verse):
        assert verdict(text)["n_removed_lines"] == 0 and verdict(text)["kept"]


def test_repetition():
    assert repeated_words(b"a b c a b c".split()) == 6
    assert repeated_words(b"a b c d a b c".split()) == 6
    assert repeated_words(b"a a a a".split()) == 4
    assert repeated_words(b"a b".split()) == repeated_words([]) == 0


def test_verdicts():
    of = verdict
    assert of(PROSE)["kept"] and of(PROSE + "\nAll rights reserved.")["kept"]
    bad = of(PROSE + "\n" + " | ".join(f"x{k}" for k in range(70)))
    assert not bad["base_failed"] and not bad["kept"] and bad["clean_text"] == PROSE
    assert of("too short")["base_failed"] and of(" ".join(["again and again"] * 30))["base_failed"]
    two = of("x y\n\n \nx y\nz\nx y")
    assert (two["n_dup_lines"], two["n_words"], two["word_chars"]) == (2, 7, 7)


def test_as_columns(docs):
    df = docs([(1, None, 5), (2, "", 5), (2, PROSE, 5), (None, PROSE + " x" * 100000, 5)], ", kept int")
    rows = {(r["doc_id"], r["n_words"]): r["kept"] for r in quality.quality(df).collect()}
    assert rows == {(1, 0): False, (2, 0): False, (2, 60): True, (None, 100060): False}
    assert quality.quality(docs([])).collect() == []


def test_sql_twin(docs):
    """The twin, stated apart from the module, on every kind of line."""
    menu = "\n".join(["Home", "News", "", "About us", "Kontakt", "会社概要"])
    lines = [menu, "Accueil › Produits › Chaussures", "« Bonjour » « Salut » dit-il.", "});", '"', "Er sagte gestern, dass …”", " ".join(f"tag{k}" for k in range(45)),
             "A\u00a0b | c | d e", "STOP!! IT!! NOW!! PLEASE", "see our Privacy Policy", "\r", "one\rtwo three"]
    rows = [(k, line + "\n" + " ".join(f"w{j}" for j in range(n)) + ".", 0) for n in (45, 52, 70) for k, line in enumerate(lines * 2)]
    rows += [(90, None, 0), (91, "", 0), (92, "\n\n", 0), (93, "\n".join(lines), 0), (94, "\n".join(lines * 4), 0), (94, PROSE, 0)]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    ours = sorted(tuple(r[c] for c in names) for r in quality.quality(docs(rows, ", other int")).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r[:2]) for r in rows])
    assert sorted(con.sql(f"SELECT {', '.join(names)} FROM ({ORACLE['op6_quality_rules']})").fetchall()) == ours
