"""Mentions in other forms, and texts that a pattern could lose itself in."""

import re

from tailrace.llm import surrogates


def replaced(spark, texts):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id int, text string, `a.b` int")
    rows = surrogates.surrogated(df, "k").collect()
    assert rows[0].__fields__ == ["doc_id", "text", "a.b", "n_entities"]
    return {texts[r.doc_id]: r.text for r in rows}


def valid_iban(text):
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def test_forms(spark):
    names = ["Mr. McDonald met Mr. O'Neil.", "Herr von Trapp-Klein lacht", "Signora Della Rovere"]
    secrets = ["token = aaaaaa.bbbbbb.cccccc", "password: p@ss!w0rd1 done", "secret='q.w-e~r#t9'"]
    phones = ["call +1 (743) 555-3824", "or +17435553824", "or +49 30 1234567"]
    numbers = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE88370400440532013000", "at 2001:db8::ff00:42:8329", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"]
    plain = ["at 12:30:45 a::b", "std::vector", "Mrs.", "10:20::x"]
    new = replaced(spark, names + secrets + phones + numbers + plain)
    assert all(new[t] == t for t in plain)
    for t, parts in zip(names + secrets, (["Donald", "Neil"], ["Trapp", "Klein"], ["Della", "Rovere"], ["aaaaaa", "bbbbbb", "cccccc"], ["p@ss", "w0rd1"], ["q.w", "r#t9"])):
        assert not any(p in new[t] for p in parts), new[t]
    assert new[secrets[1]].endswith(" done") and new[names[0]].endswith(".")
    digits = [re.sub("[^0-9]", "", new[p]) for p in phones]
    assert digits[0] == digits[1] != "17435553824" and digits[0][0] == "1" and digits[2].startswith("49")
    assert [valid_iban(new[n]) for n in numbers[:4]] == [True, True, True, False] == [valid_iban(n) for n in numbers[:4]]
    assert new[numbers[0]] == new[numbers[1]].replace(" ", "") != numbers[0]
    assert new[numbers[4]] != numbers[4] and re.fullmatch("at [0-9a-f:]+", new[numbers[4]]) and re.fullmatch("[0-9a-f:]+", new[numbers[5]])


def test_long_texts_of_short_parts(spark):
    """A megabyte each; a greedy group would overflow the stack after some thousand turns."""
    parts = ["a.", "a@", "1.", "Aa-", "a:", "Mr. A", "+1 ", "x=a.b@"]
    assert len(replaced(spark, [p * (1_000_000 // len(p)) + " b and 1" for p in parts])) == len(parts)


def test_names_without_title_and_under_others(spark):
    texts = [
        "Mrs. Anna Smith came. Anna Smith and Smith's son left; Annabel Smithson did not. Smith",
        "Dr. Anna Smith spoke. Password: Hunterpass1 Anna",
        "Anna Smith alone, no title",
        "Mr. Otto Smith, Frau Otto, Mrs. Anna",
        "Госпожа Анна Петрова; Петрова пришла",
        "Mr. " + "Ab " * 3 + "Smith " + "Ab " * 20000 + "end",
    ]
    rows = {r.doc_id: r for r in surrogates.surrogated(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), "k").collect()}
    new = {i: r.text for i, r in rows.items()}
    anna, smith = re.match(r"Mrs\. (\w+) (\w+) came", new[0]).groups()
    assert new[0] == f"Mrs. {anna} {smith} came. {anna} {smith} and {smith}'s son left; Annabel Smithson did not. {smith}"
    assert anna.endswith("a") and anna != "Anna" and smith != "Smith"
    assert new[1].startswith(f"Dr. {anna} {smith} spoke. Password: ") and new[1].endswith(f" {anna}") and "Hunter" not in new[1]
    assert new[2] == texts[2]
    otto = re.match(r"Mr\. (\w+) ", new[3]).group(1)
    assert new[3] == f"Mr. {otto} {smith}, Frau {otto}, Mrs. {anna}" and otto.endswith("l")
    one, two = re.match(r"Госпожа (\w+) (\w+);", new[4]).groups()
    assert new[4] == f"Госпожа {one} {two}; {two} пришла" and one.endswith("а") and re.fullmatch("[а-яА-Я]+", one + two)
    assert " Ab " not in new[5] and len(new[5].split(" ")) == len(texts[5].split(" "))
    assert [rows[i].n_entities for i in range(5)] == [5, 3, 0, 3, 2]


def test_more_identities_than_attempts_find_room_for(spark):
    from tailrace.llm.tables import Tables

    rows = [("ssn", f"{i:04d}") for i in range(9000)] + [("ip", f"10.0.0.{i}") for i in range(1, 200)] + [("name", f"n{i}") for i in range(500)]
    identities = spark.createDataFrame([(*r, "n") for r in rows], "kind string, identity string, gender string")
    got = surrogates.surrogate_table(identities, "k", Tables(spark, "few"), attempts=3).collect()
    assert sorted((r.kind, r.identity) for r in got) == sorted(rows)
    assert len({(r.kind, r.core) for r in got}) == len(rows)
    assert all(r.core != r.identity for r in got)
    short = [r for r in got if r.kind == "ssn"]
    assert all(re.fullmatch("[0-9]{4}", r.core) for r in short) and sum(int(r.core) < 9000 for r in short) > 7000
