import re

from tillscope.llm import pseudonyms as p

TEXT = (
    "Mail Ann.Lee9@mail7.example.com or ann.lee9@mail7.example.com, card 4111 1111 1111 1111 and 4111111111111111, "
    "IBAN DE89 3704 0044 0532 0130 00, born 1984-02-29, 31/12/1999, 02/13/2001; SSN 123-45-6789; host 10.0.0.1; "
    'call +1 (017) 555-7713 190.137.223.204 or (415) 555-2671 or +49 30 1234567; token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" '
    'TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"'
)
CLEAN = ["no data here", "4111 1111 1111 1112 has a wrong digit", "version 1.2.3 of 2024", "300.1.1.1", "1999-13-45", "9807915762804491",
         "a@b", "000-12-3456", "DE00 3704 0044 0532 0130 00", "12345", "", "@@@ ... +++ ((("]


def test_every_kind_and_back():
    new, spans = p.replace(TEXT, p.Cipher(b"k"))
    kinds = [k for k, _, _ in spans]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "email": 2, "card": 2, "iban": 1, "date": 3, "social": 1, "address": 2, "phone": 3, "secret": 2
    }
    for a, b, _, _ in p.find(TEXT, p.Cipher(b"k")):
        assert TEXT[a:b] not in new
    assert p.replace(new, p.Cipher(b"k", back=True))[0] == TEXT
    assert p.replace(TEXT, p.Cipher(b"other"))[0] != new


def test_formats_stay_valid():
    new, spans = p.replace(TEXT, p.Cipher(b"k"))
    for kind, a, b in spans:
        value = new[a:b]
        if kind == "card":
            digits = re.sub(r"\D", "", value)
            assert p.luhn(digits[:-1]) == int(digits[-1])
        if kind == "address":
            assert all(0 <= int(x) <= 255 for x in value.split("."))
    assert re.sub(r"[A-Za-z0-9]+", "w", new) == re.sub(r"[A-Za-z0-9]+", "w", TEXT)


def test_equal_values_stay_linked():
    cipher = p.Cipher(b"k")
    one, two = (p.replace(f"x {v} y", cipher)[0] for v in ("4111 1111 1111 1111", "4111-1111-1111-1111"))
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two)
    assert p.replace("ann.lee9@x.com", cipher)[0] == p.replace("ANN.LEE9@x.com", cipher)[0].lower()


def test_permutations_are_one_to_one():
    cipher, back = p.Cipher(b"k"), p.Cipher(b"k", back=True)
    for n in (1, 2, 7, 100, 366):
        image = [cipher.permute(x, n, "t") for x in range(n)]
        assert sorted(image) == list(range(n)) and [back.permute(y, n, "t") for y in image] == list(range(n))


def test_clean_texts_stay():
    for t in CLEAN:
        assert p.replace(t, p.Cipher(b"k")) == (t, [])


def test_table(documents):
    long = "word " * 40_000 + "ann@example.org" + " 1" * 30_000
    rows = [(1, TEXT), (1, TEXT), (2, None), (3, ""), (None, "ann@example.org"), (4, long)]
    docs = documents(rows)
    new = p.pseudonymise(docs, b"k")
    got = new.collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[2].text is None and by[3].text == "" and by[4].n_replaced == 1 and by[None].text in by[4].text
    back = {r.doc_id: r.text for r in p.pseudonymise(new, b"k", back=True).collect()}
    assert back == dict(rows)
    assert p.pseudonymise(documents([]).limit(0), b"k").collect() == []


def test_cards_and_ibans_beside_other_groups():
    cipher, back = p.Cipher(b"k"), p.Cipher(b"k", back=True)
    one, other, iban = "4111 1111 1111 1111", "5500-0000-0000-0004", "DE89 3704 0044 0532 0130 00"
    for text, values in (
        (f"{one} 12/27", [one]), (f"{one} 123", [one]), (f"{one} 123 12/27", [one]), ("4111111111111111 123", ["4111111111111111"]),
        (f"7 {one}", [one]), (f"{one} {other}", [one, other]), (f"{other} {one} 12", [other, one]), (f"{one} 7.50", [one]),
        ("7536784127813050 4845168114407329", ["7536784127813050", "4845168114407329"]),
        ("DE89370400440532013000 EUR 100", ["DE89370400440532013000"]), (f"IBAN {iban} BIC COBADEFF", [iban]),
        (f"{iban} {iban}", [iban, iban]), ("CH93 0076 2011 6238 5295 7 ZKB", ["CH93 0076 2011 6238 5295 7"]),
    ):
        assert [text[a:b] for a, b, _, _ in p.find(text, cipher)] == values, text
        new, spans = p.replace(text, cipher)
        assert len(spans) == len(values) and not any(v in new for v in values)
        assert p.replace(new, back)[0] == text
    # The same number gets the same pseudonym whatever stands beside it, and going back finds it.
    for k in range(300):
        body = f"4{k:03d}{k * 7919 % 10**11:011d}"
        number = body + str(p.luhn(body))
        for tail in (" 12/27", " 123", " 1234", f" {number}"):
            new = p.replace(number + tail, cipher)[0]
            assert p.replace(new, back)[0] == number + tail


def test_values_at_starts_and_after_punctuation():
    cipher, back = p.Cipher(b"k"), p.Cipher(b"k", back=True)
    for kind, value in (
        ("phone", "555-123-4567"), ("phone", "555.123.4567"), ("date", "2021-03-14"), ("date", "3/4/2021"), ("date", "14.3.2021"),
        ("date", "3/14/2021"), ("date", "2021-3-4"), ("date", "03/4/2021"),
    ):
        for before in ("", "a\n", "\t", '"', "tel:", "(", "[", "/x "):
            text = f"{before}{value}, then"
            assert [(k, text[a:b]) for a, b, k, _ in p.find(text, cipher)] == [(kind, value)], text
            new = p.replace(text, cipher)[0]
            assert value not in new and len(new) == len(text) and p.replace(new, back)[0] == text
    for text, value in (("at 2021-03-04T10:00", "2021-03-04"), ("2021-03-04T10:00:00Z", "2021-03-04"), ("2021-03-04T1000", "2021-03-04"),
                        ("API_KEY=abcd1234", "abcd1234"), ("x\npassword: hunter22x\n", "hunter22x"), ('{"a":1,token:abcd1234,user:b}', "abcd1234"),
                        ("(PASSWORD=Tr0ub4dor&3x y", "Tr0ub4dor&3x"), ("?token=abcd1234&user=bob", "abcd1234"), ("pwd = hunterhunter", "hunterhunter")):
        assert [text[a:b] for a, b, _, _ in p.find(text, cipher)] in ([value], [text[text.lower().find(w) : text.find(value) + len(value)]
            for w in ("api_key", "password", "token", "pwd") if w in text.lower()]), text
        new = p.replace(text, cipher)[0]
        assert value not in new and p.replace(new, back)[0] == text
    for text in ("The secret: everything else", "token = get_token(x)", "if password == other_password:", "password=${PASSWORD}", "2021-13-4", "2021-03-04Tea", "1.2.3"):
        assert p.replace(text, cipher) == (text, []), text
