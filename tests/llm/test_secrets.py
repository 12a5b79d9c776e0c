import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from gridtally.llm import secrets

AWS = "AKIA" + "Q7" * 8
RANDOM = "wJalrXUtnFEMI/K7MDENG+bPxRfiCYzEXAMPLEKEY"


def base_by_hand(text):
    text = text or ""
    found = []
    for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text, re.IGNORECASE | re.ASCII,
    ):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


PARTS = [
    "token = \"", "TOKEN:", "Api_Key=", "ſecret=", "password' : '", AWS, "AKIAAKIA", "0123456789abcdef", "ffff",
    "é", " ", "\n", "\n\n", "abcdefABCDEF123", "=", RANDOM, "user: bob77", "https://x.example.com/a", "İ",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_base_spans_equal_plain_patterns(text):
    base, every = secrets.spans_of(text)
    assert ",".join(f"{k}:{a}:{b}" for a, b, k in base) == base_by_hand(text)
    assert set(base) <= set(every)
    assert "AKIA" + "Q7" * 8 not in secrets.masked(text)


def kinds(text):
    return [k for _, _, k in secrets.spans_of(text)[1]]


def test_weak_parts_need_their_complement():
    assert kinds(f"see {RANDOM} here") == []
    assert kinds("user: bob77 at https://x.example.com") == []
    assert kinds(f"{AWS} and {RANDOM}") == ["access", "token"]
    assert kinds(f"user: bob77 {RANDOM} https://x.example.com") == ["identifier", "token", "endpoint"]
    assert kinds(f"{AWS}\n\n{RANDOM}") == ["access"]  # another scope
    assert kinds(f"{AWS}{' x' * 150} {RANDOM}") == ["access"]  # out of reach


def test_settings_join_at_any_distance_in_their_scope():
    rest = "".join(f'  "field_{i}": "some plain words",\n' for i in range(30))
    account = '{{\n  "client_id": "robot77",\n{}  "private": "{}",\n{}  "auth_uri": "https://x.example.com/a"\n}}'
    text = account.format(rest, RANDOM, rest)
    assert kinds(text) == kinds(text.replace("\n", "")) == ["identifier", "token", "endpoint"]
    assert RANDOM not in secrets.masked(text) and "robot77" not in secrets.masked(text)
    assert kinds(f"{AWS}\n{rest}value = {RANDOM}\n{rest}region = eu-west-1") == ["access", "token", "endpoint"]
    assert kinds(f"{AWS}\n\nvalue = {RANDOM}") == ["access"]


def test_many_parts_stay_linear():
    text = f"user: bob77 {RANDOM} " * 3000
    assert len(kinds(text)) == 6000


def test_rows(spark):
    texts = [None, "", f"x {AWS}", "token=abcdefabcdef0123", "a " * 60_000 + "token=abcdefabcdef0123", f"x {AWS}"]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, spans string")
    rows = {r.doc_id: r for r in secrets.find(docs).collect()}
    for i, text in enumerate(texts):
        assert rows[i].base_sha256 == hashlib.sha256(base_by_hand(text).encode()).hexdigest()
    assert (rows[3].n_assign, rows[3].n_access, rows[3].n_hex) == (1, 0, 1)
    assert rows[4].n_assign == 1 and rows[2].n_access == 1
    clean = {r.doc_id: r for r in secrets.redacted_documents(docs).collect()}
    assert clean[0].text is None and clean[3].text == secrets.MASK and clean[3].n_chars == len(secrets.MASK)
    assert clean[0].spans == "s"
    assert secrets.find(docs.limit(0)).count() == 0


def test_any_number_of_blanks_before_a_value():
    for blanks in (0, 10, 100, 50_000):
        text = f"user: bob77{' x' * 150}\nprivate:{' ' * blanks}\"{RANDOM}\""
        assert kinds(text) == ["identifier", "token"]
        assert RANDOM not in secrets.masked(text)
    assert not secrets.is_setting("x " + " " * 500 + RANDOM, 502)


def links_by_hand(text):
    """All spans, from all pairs of parts."""
    base, _ = secrets.spans_of(text)
    scope = [0] * (len(text) + 1)
    breaks = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    for i in range(len(scope)):
        scope[i] = sum(b <= i for b in breaks)
    names = [(m.start(), m.end(), "identifier") for m in secrets.NAMED.finditer(text)]
    taken = base + names
    tokens = [
        (m.start(), m.end(), "token")
        for m in secrets.TOKEN.finditer(text)
        if secrets.looks_random(m[0]) and not any(a < m.end() and m.start() < b for a, b, _ in taken)
    ]
    ends = [(m.start(), m.end(), "endpoint") for m in secrets.ENDPOINT.finditer(text)]

    def setting(span):
        if span[2] == "endpoint" and not secrets.URI.match(text[span[0] :]):
            return True
        return text[: span[0]].rstrip(" \t\r\n\"'").endswith((":", "="))

    def joined(span, others, always=False):
        return any(
            scope[span[0]] == scope[o[0]]
            and (always or setting(span) or max(o[0] - span[1], span[0] - o[1]) <= secrets.REACH)
            for o in others
        )

    ids = names + [s for s in base if s[2] == "access"]
    found = [t for t in tokens if joined(t, ids)]
    keys = [s for s in base if s[2] != "access"] + found
    if not ids:
        return sorted(base)
    found += [n for n in names if joined(n, keys, True)]
    found += [e for e in ends if joined(e, ids) and joined(e, keys)]
    return sorted(base + found)


FILLER = [" plain words " * 9, "\n\n", "\n \n", "private: ", "key =\n", "server: host.example.com", "client_id=robot77", " " * 90]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS + FILLER), max_size=14).map(" ".join))
def test_links_equal_all_pairs(text):
    assert sorted(secrets.spans_of(text)[1]) == links_by_hand(text)
