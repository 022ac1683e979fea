import re

import pytest

from tidegate.llm import secrets
from tidegate.llm.secrets import Rule, derive


def spans(rows):
    return [[tuple(s) for s in r["spans"]] for r in rows]


def test_queries_of_patterns():
    assert derive("abcd") == [["abc", "bcd"]]
    assert derive("[0-9a-f]{24,}") is None and derive("ab") is None and derive("(abc)?") is None and derive("x*abc") == [["abc"]]
    assert derive("abc.def") == [["abc", "def"]]
    assert derive("(abc|xyz)1") == [["abc", "bc1"], ["xyz", "yz1"]]
    assert derive("ab[cd]") == [["abc"], ["abd"]]
    assert derive("AKIA[A-Z0-9]{16,}") == [["aki", "kia"]]
    assert derive("(foo)+bar") == [["bar", "foo"]]


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_every_match_satisfies_the_query(rule):
    samples = [
        "PassWord = 'abcdef1'", "api_key:xyzxyz9", "apikey: 'secret12'", "TOKEN=..........", "AKIA" + "Z" * 16, "0" * 40, "-----BEGIN RSA PRIVATE KEY-----",
        "ghp_" + "a" * 36, "xoxb-1234567890-ab", "AIza" + "x" * 35, "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh1", "ftp://u:p@h",
    ]
    found = [s for s in samples if re.search(rule.pattern, s, re.ASCII)]
    assert found
    query = derive(rule.pattern)
    for s in found:
        assert query is None or any(all(t in s.lower() for t in clause) for clause in query)


def test_against_plain_search(docs):
    texts = [
        None, "", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" x", "token=\"token\": abcdefgh", "PASSWD:short secret:longer1",
        "ſecret=abcdefgh toKen=abcdefgh", "AKIA" + "A" * 15 + " AKIA" + "B" * 16, "漢字 api-key=1 apikey='漢' api_key='abcdef'", "password = token = abcdefg",
        "0123456789abcdef01234567 " * 3, "pas swo ord", "x" * 5000 + " secret:" + "y" * 5000, "ghp_" + "a" * 40,
    ]
    df = docs([(k, t, "x") for k, t in enumerate(texts)] + [(2, texts[3], "x"), (None, texts[4], "x")], ", spans string")
    out = {}
    for r in secrets.scan(df.repartition(3)).collect():
        out.setdefault(r["text"], []).append([(s["kind"], s["start"], s["end"]) for s in r["spans"]])
    base = {"assign": (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24)}
    for t, found in out.items():
        want = []
        for order, (kind, (p, g, least)) in enumerate(base.items()):
            want += [(m.start(), order, kind, m.end()) for m in re.finditer(p, t or "") if len(m[g]) >= least]
        want = [(k, s, e) for s, _, k, e in sorted(want)]
        for one in found:
            assert [x for x in one if x[0] in base] == want, t
    assert sum(map(len, out.values())) == len(texts) + 2


def test_own_rules_and_empty_table(docs):
    assert secrets.scan(docs([])).collect() == []
    found = secrets.scan(docs([(1, "abc1 abc22")]), (Rule("n", r"abc([0-9]+)", 1, 2),)).collect()
    assert [tuple(s) for s in found[0]["spans"]] == [("n", 5, 10)]
