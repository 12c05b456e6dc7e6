import datetime as dt
import ipaddress
import re

from tidemark.llm import pii

KEY = b"test key"


def card(body):
    return body + str(-pii._luhn(body + "0") % 10)


def test_permutations_are_bijections_on_valid_values():
    p = pii.Pseudonyms(KEY)
    even = lambda v: v % 2 == 0
    assert sorted(p.permute("k", v, 500) for v in range(500)) == list(range(500))
    assert sorted(p.permute("k", v, 500, even) for v in range(0, 500, 2)) == list(range(0, 500, 2))
    assert [p.permute("k", v, 500) for v in range(9)] != [pii.Pseudonyms(b"other").permute("k", v, 500) for v in range(9)]
    days = [f"{dt.date(2001, 1, 1) + dt.timedelta(d)}" for d in range(300)]
    new = [p.date(d) for d in days]
    assert len(set(new)) == 300 and all(dt.date.fromisoformat(d) for d in new)
    cards = [card(f"4{n:014d}") for n in range(200)]
    got = [p.card(c) for c in cards]
    assert len(set(got)) == 200 and all(pii._luhn(c) == 0 and c[0] == "4" and len(c) == 16 for c in got)


def test_formats_stay_and_equal_values_stay_linked():
    p = pii.Pseudonyms(KEY)
    c = card("453201511283036")
    texts = {
        f"pay {c} now": "card", f"pay {c[:4]} {c[4:8]} {c[8:12]} {c[12:]} now": "card",
        "born 1984-02-29.": "date", "born 29.02.1984!": "date", "call +1 (988) 555-2485 or": "phone", "id 219-09-9999.": "ssn",
        "ip 42.144.35.254 end": "ip", "mail hsr.29@mail5.example.com x": "email", "iban GB82 WEST 1234 5698 7654 32 x": "iban",
    }
    new = {}
    for t, kind in texts.items():
        out, found = p.replace(t)
        assert dict(found) == {kind: 1} and out != t and (kind == "ip" or len(out) == len(t))
        assert re.sub(r"[A-Za-z0-9]", "", out) == re.sub(r"[A-Za-z0-9]", "", t)
        new[t] = out
    a, b = list(new.values())[:2]
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    x, y = list(new.values())[2:4]
    assert x[5:15] == "-".join(reversed(y[5:15].split(".")))
    iban = re.sub(" ", "", new["iban GB82 WEST 1234 5698 7654 32 x"][5:-2])
    assert pii._mod97(iban[4:] + iban[:4]) == 1


def test_neighbouring_values_do_not_run_together():
    p = pii.Pseudonyms(KEY)
    c = card("453201511283036")
    text = f"+1 (269) 555-3296 {c[:4]} {c[4:8]} {c[8:12]} {c[12:]} 27.65.93.188 +1 (988) 555-2485"
    new, found = p.replace(text)
    assert found == {"phone": 2, "card": 1, "ip": 1}
    assert not any(x in new for x in ("555-3296", c[4:12], "27.65.93", "555-2485"))


def test_invalid_values_are_left_alone():
    p = pii.Pseudonyms(KEY)
    for t in ("4111 1111 1111 1112", "1984-02-30", "300.1.2.3", "000-12-3456", "version 1.2.3", "2024", "GB82 WEST 1234 5698 7654 33", "9870157079875990"):
        assert p.replace(t)[0] == t


def test_rows(docs, edge_docs):
    rows = [(1, "a hsr.29@mail5.example.com"), (2, "b hsr.29@mail5.example.com")]
    one, two = pii.pseudonyms(docs(rows), KEY).orderBy("doc_id").collect()
    assert one.text[2:] == two.text[2:] != rows[0][1][2:] and one.kinds == "email:1"
    got = pii.pseudonyms(edge_docs, KEY).collect()
    want = {(r.doc_id, r.text) for r in edge_docs.collect()}
    assert {(r.doc_id, r.text) for r in got} == want and len(got) == edge_docs.count()
    assert pii.pseudonyms(docs([]), KEY).collect() == []


def only(p, text, kind):
    new, found = p.replace(text)
    assert dict(found) == {kind: 1}, (text, found)
    return new


def test_phones_in_every_layout_share_a_pseudonym():
    p = pii.Pseudonyms(KEY)
    forms = ["+49 30 1234567", "+49-30-1234567", "0049 30 1234567", "+49301234567", "+49 (30) 123 45 67", "+49 (0)30 1234567", "+4930 1234567"]
    new = [only(p, f"call {f}, please", "phone")[5:-8] for f in forms]
    assert [re.sub(r"\d", "", n) for n in new] == [re.sub(r"\d", "", f) for f in forms]
    own = {re.sub(r"\D|\(0\)", "", n).removeprefix("00").removeprefix("49") for n in new}
    own = {x.removeprefix("0") if len(x) == 10 else x for x in own}
    assert len(own) == 1 and own != {"301234567"}
    assert only(p, "988-555-2485", "phone").replace("-", "") == re.sub(r"\D", "", only(p, "+1 (988) 555-2485", "phone"))[1:]
    assert only(p, "+353 1 234 5678", "phone").startswith("+353 ")
    for t in ("+1 555", "12 + 34 56", "0049", "id 00493012345678901234567"):
        assert p.replace(t) == (t, {})
    c = card("453201511283036")
    new, found = p.replace(f"+49 30 1234567 {c[:4]} {c[4:8]} {c[8:12]} {c[12:]}")
    assert found == {"phone": 1, "card": 1} and c[:4] + " " + c[4:8] not in new


def test_numbers_outside_the_plan_stay_different():
    p = pii.Pseudonyms(b"k")
    assert p.ip("255.1.2.3") != p.ip("239.173.158.226")
    outside = [f"+1 {a}55 {b}12 {n:04d}" for a in "01" for b in "15" for n in range(40)]
    inside = [f"+1 {a}55 {b}12 {n:04d}" for a in "29" for b in "25" for n in range(40)]
    new = {p.phone(x) for x in outside + inside}
    assert len(new) == len(outside + inside)
    assert all(x[3] >= "2" and x[7] >= "2" for x in map(p.phone, inside))


def test_dates_in_every_layout_share_a_pseudonym():
    p = pii.Pseudonyms(KEY)
    for d in (dt.date(2020, 1, 25), dt.date(2020, 2, 3)):
        iso = dt.date.fromisoformat(p.date(f"{d}"))
        assert (iso.day > 12) == (d.day > 12) and iso != d
        assert p.date(f"{d:%d.%m.%Y}") == f"{iso:%d.%m.%Y}" and p.date(f"{d:%Y/%m/%d}") == f"{iso:%Y/%m/%d}"
        if d.day > 12:
            assert p.date(f"{d:%m/%d/%Y}") == f"{iso:%m/%d/%Y}"
    days = [f"{dt.date(2001, 1, 1) + dt.timedelta(n)}" for n in range(400)]
    assert len({p.date(x) for x in days}) == 400


def test_ipv6_addresses():
    p = pii.Pseudonyms(KEY)
    forms = ["2001:db8:85a3::8a2e:370:7334", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2001:DB8:85A3:0:0:8A2E:370:7334"]
    new = [only(p, f"from {f} today", "ipv6")[5:-6] for f in forms]
    assert len({ipaddress.IPv6Address(n) for n in new}) == 1 and new[0].startswith("2001:") and new[0] not in forms
    assert new[2] == new[2].upper() and len(new[1]) == 39
    only(p, "fe80::1", "ipv6")
    for t in ("at 12:30:45", "std::vector", "a::b", "2001:99", "2001:db8:1:2:3", "::1"):
        assert p.replace(t) == (t, {})


def test_email_addresses_beyond_ascii():
    p = pii.Pseudonyms(KEY)
    new = only(p, "an Jos\u00e9.N\u00fa\u00f1ez@ex\u00e4mple.org geschickt", "email")
    assert new.endswith("@ex\u00e4mple.org geschickt") and "N\u00fa\u00f1ez" not in new and new[3].isupper()
    names = [a + b + c for a in "\u00e9\u00e8x" for b in "\u0438\u043d" for c in "ab7"]
    assert len({p.email(f"{n}@x.org") for n in names}) == len(names)
    assert only(p, "\u8054\u7cfbme.too@x.org", "email").startswith("\u8054\u7cfb")
