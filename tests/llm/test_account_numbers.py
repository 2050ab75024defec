"""Account numbers beside other words, and what stands in a text that only looks like one."""

from __future__ import annotations

import re

from ledgerloom.llm import pseudonyms


def made(country, account):
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{country}{98 - int(number) % 97:02d}{account}"


def test_words_beside_account_numbers(documents):
    numbers = ["ES9121000418450200051332", "BE68539007547034", "AT611904300234573201", "NO9386011117947", "DE89370400440532013000", "PL61109010140000071219812874", "GB29NWBK60161331926819", made("ZZ", "12345678901234567")]
    after = ["EUR", "A", "2024", "BIC", "EURO 2024 EUR", "1234 5678"]
    texts = [(n, w, form) for n in numbers for w in after for form in (n, " ".join(re.findall(".{1,4}", n)))]
    got = {r["doc_id"]: r["text"] for r in pseudonyms.report(documents([(i, f"pay {form} {w}") for i, (_, w, form) in enumerate(texts)])).collect()}
    for i, (n, w, form) in enumerate(texts):
        plain = got[i].removeprefix("pay ").removesuffix(f" {w}").replace(" ", "")
        assert got[i].endswith(f" {w}") and len(got[i]) == len(f"pay {form} {w}") and plain != n and plain[:2] == n[:2], got[i]
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    for n in numbers:  # equal values, equal pseudonyms
        assert len({got[i].removeprefix("pay ").removesuffix(f" {w}").replace(" ", "") for i, (m, w, _) in enumerate(texts) if m == n}) == 1


def test_other_forms_in_what_looks_like_an_account_number(documents):
    card, spaced, iban = "4041894974608795", "4041 8949 7460 8795", "ES9121000418450200051332"
    texts = [f"NO12 {card}", f"ES12 1234 1234 1234 1234 {spaced}", f"AB12 {spaced} 1234", f"AB12 CDEF 1234 {iban} EUR", "AB12 3456 7890 1234 5678"]
    rows = {r["doc_id"]: r for r in pseudonyms.report(documents(list(enumerate(texts)))).collect()}
    for i, hidden in enumerate((card, "8949 7460 8795", spaced, iban)):
        assert hidden not in rows[i]["text"] and len(rows[i]["text"]) == len(texts[i]), rows[i]
    assert rows[4]["text"] == texts[4] and rows[4]["n_found"] == 2  # forms of an account number and of a card
