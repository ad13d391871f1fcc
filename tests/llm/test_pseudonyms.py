import re

import pytest

from tidemark.llm.pseudonyms import pseudonymised

TEXTS = [
    "card 4111 1111 1111 1111 and 4111111111111112 is none",
    "again 4111111111111111$$$ and +1 (599) 555-3756 or 599-555-3756",
    "ip 192.168.1.254, not 999.1.1.1 nor 1.2.3.4.5",
    "on 2024-02-29, 31/12/1999 or 12/31/1999, never 2023-02-30",
    "ssn 123-45-6789 but not 000-45-6789",
    "mail jo.e55@mail9.example JO.E55@MAIL9.EXAMPLE",
    "iban DE89 3704 0044 0532 0130 00, wrong DE89370400440532013001",
    None,
    "",
    "plain words, 12 of them",
]


@pytest.fixture(scope="module")
def masked(spark):
    rows = [(i, t, f"x{i}") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, value string")
    return pseudonymised(docs, "key", originals=True).collect()


def luhn(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def iban(number):
    plain = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def test_valid_values_change_and_keep_their_format(masked):
    for row in masked:
        for hit in row["found"]:
            assert hit["value"] not in row["text"] and hit["pseudonym"] in row["text"]
            shape = lambda s: re.sub("[A-Za-z]", "a", re.sub(r"\d", "9", s))
            if hit["kind"] != "address":
                assert shape(hit["value"]) == shape(hit["pseudonym"])
    kinds = {h["kind"]: h["pseudonym"] for r in masked for h in r["found"]}
    assert set(kinds) == {"card", "phone", "address", "date", "social", "email", "iban"}
    assert luhn(kinds["card"]) and iban(kinds["iban"])
    assert all(0 <= int(p) <= 255 for p in kinds["address"].split("."))


def test_invalid_values_and_other_text_stay(masked):
    texts = [r["text"] for r in masked]
    assert "4111111111111112" in texts[0] and "999.1.1.1 nor 1.2.3.4.5" in texts[2]
    assert "2023-02-30" in texts[3] and "000-45-6789" in texts[4] and "DE89370400440532013001" in texts[6]
    assert texts[7:10] == [None, "", "plain words, 12 of them"] and all(r["found"] == [] for r in masked[7:10])
    assert [r["value"] for r in masked] == [f"x{i}" for i in range(10)] + [None]


def test_equal_values_stay_linked(masked, spark):
    by = {re.sub(r"\D", "", h["value"]): re.sub(r"\D", "", h["pseudonym"]) for h in masked[0]["found"]}
    assert masked[1]["found"][0]["pseudonym"] == by["4111111111111111"]
    assert masked[-1]["text"] == masked[0]["text"]
    mails = [h["pseudonym"] for h in masked[5]["found"]]
    assert mails[0].upper() == mails[1]
    docs = spark.createDataFrame([(0, TEXTS[0])], "doc_id long, text string")
    assert pseudonymised(docs, "other").first()["text"] != masked[0]["text"]


def test_permutes_whole_domain(spark):
    """Every day of the domain has its own pseudonym: nothing collides, nothing leaves the domain."""
    days = spark.sql(
        "select id doc_id, date_format(date_add(date'1900-01-01', cast(id as int)), 'yyyy-MM-dd') text from range(0, 73049, 7)"
    )
    texts = [r["text"] for r in pseudonymised(days, "k").select("text").collect()]
    assert len(set(texts)) == len(texts) == 10436
    assert all("1900-01-01" <= t <= "2099-12-31" for t in texts)


def test_empty_table(spark):
    assert pseudonymised(spark.createDataFrame([], "doc_id long, text string"), "k").collect() == []


@pytest.mark.parametrize(("text", "value"), [
    ("pay 4111111111111111 123 now", "4111111111111111"),
    ("order 12 4111111111111111 ok", "4111111111111111"),
    ("4111 1111 1111 1111 99", "4111 1111 1111 1111"),
    ("1234 5678 9012 4111 1111 1111 1111 7", "4111 1111 1111 1111"),
    ("AT611904300234573201 BANK", "AT611904300234573201"),
    ("call +1 (017) 555-7713 22", "+1 (017) 555-7713"),
])
def test_neighbours_are_not_taken_along(spark, text, value):
    docs = spark.createDataFrame([(0, text), (1, value)], "doc_id long, text string")
    first, alone = pseudonymised(docs, "key", originals=True).orderBy("doc_id").collect()
    assert [h["value"] for h in first["found"]] == [value]
    assert first["text"] == text.replace(value, alone["text"]) and alone["text"] != value


def test_what_follows_a_card_is_found_too(spark):
    text = "4111111111111111 599-555-3756 and 5555 5555 5555 4444 4111-1111-1111-1111 2024-02-29"
    row = pseudonymised(spark.createDataFrame([(0, text)], "doc_id long, text string"), "key").first()
    assert [h["kind"] for h in row["found"]] == ["card", "phone", "card", "card", "date"]


def test_all_digits_of_long_accounts_are_permuted(spark):
    account = "PL61109010140000071219812874"
    docs = spark.createDataFrame([(0, account)], "doc_id long, text string")
    texts = [pseudonymised(docs, k).first()["text"] for k in "abcdef"]
    assert all(iban(t) and len(t) == len(account) for t in texts)
    assert len({t[4:9] for t in texts}) > 4 and all(t[4:9] != account[4:9] for t in texts)


def test_long_texts_and_no_originals_in_the_output(spark):
    texts = ["a@b" + ".c" * 100_000, "plain " * 200_000 + "jo@mail.example", "9" * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pseudonymised(docs, "k").collect()}
    assert rows[0]["text"].endswith(".c") and rows[2]["text"] == texts[2]
    assert [set(h.asDict()) for h in rows[1]["found"]] == [{"kind", "pseudonym"}]
    assert "jo@mail.example" not in str(rows[1])
