"""Personal information: texts put together from labelled parts and traps, so that every true position is known."""

import random

import pytest

from foliate.llm import pii
from foliate.llm.queries import p9_found, p9_redacted

GIVEN = ["Alice", "Frank", "Grace", "Jürgen", "Zoé", "Hernán"]
AUTO, SET = pii.automaton(GIVEN), frozenset(GIVEN)

EMAIL = ["a.b@example.org", "grace_x+fab@two-labs.example", "bx12 @ example.net", "kim [at] some [dot] example", "build(at)some-labs.test", "SUPPORT@EXAMPLE.COM"]
PHONE = ["(303) 555-0173", "(212)555-0119", "+1 415 555 0159", "+1-303-555-0194", "16175550174", "303.555.0142", "713-555-0199", "+44 1632 960555", "(01632) 960 798", "01632 960901", "+33 1 99 00 65 65", "01 99 00 73 12", "01.99.00.48.06", "+49 30 23125147", "030 23125 802", "(030) 23125-885", "0049-30-23125-297", "+34 900 000 846", "900 000 765", "900-000-898"]
IDS = ["000-30-9632", "666 12 3456", "QQ088041C", "QQ 95 77 81 C", "00778602X490", "00 396202 X 128", "00053177-W", "00646546X", "123139976839034", "1 20 13 99 678 704 62"]
NAMES = ["Alice Marwick", "Torsten Marbrecht", "H. Stiselby", "Marwick, Frank", "Zoé K. Driot", "Hernán Dalez-Corben", "Fiona KELBENWICK", "Jürgen Salmann"]
ADDRESS = ["221 Yarmor Lane, Rosgarbury, ZZ 00269", "12 Seltra Drive\nWalnalbury, ZZ 00123", "16 Golfen Lane\nLenstiford", "191 Walmor Ave, Floor 3, Calplobury QX3 9ZZ", "63 Bendal St., Morgrubury, ZZ 00305", "41 rue Melul, 00963 Wesgolville", "193 bis avenue Sornor\n00299 Lorwesville", "23, quai Grunal, 00107 Korgruville", "Keltrastraße 90, 00973 Taldalheim", "Bennalstr. 50, 00764 Pormorheim", "Zelbaweg 152\n00330 Trasalheim", "Plaza Sorsor 156\n00774 Ploros", "Avda. Salnal 51, 00971 Yarpal", "Calle Hesdor 20, 00546 Melzel"]
TRAPS = [
    "Grace period ends after 28.25 degrees; Frank-type sockets stay. ", "PCIe Lane 7 and Bridge Road map to l0_setup_n. ", "12 Drive strengths and 4 Court corners were swept by Klebentra Street Team. ",
    "Part no. 555-0187-567 replaces 212-44-95160. ", "Ticket 710-36-9706 links to HEAD@{1}. ", "Pinned porzelwes@9.51.0 in the lock file. ", "Build 1297321802 finished with checksum 428c4c33a9d55e09832dd8f6. ",
    "Write 343801884 to 0x68665832 then read back 29 50 77. ", "Host 192.0.2.206 answered in 20.79 MHz. ", "always @(posedge clk) a <= b; ", "Clock Tree, Power Grid and Scan Chain were frozen on 2026-04-14. ", "2026-01-01 03:00:48 INFO vormel: Für Jorvalsel1 gilt eine Verzögerung. ",
]


def templates(rng):
    pick = lambda kind, values: (kind, rng.choice(values))
    e, p, i, n, a = (lambda v=v, k=k: pick(k, v) for k, v in (("email", EMAIL), ("phone", PHONE), ("id_number", IDS), ("name", NAMES), ("address", ADDRESS)))
    return [
        lambda: ["Please contact ", n(), " at ", p(), ". "],
        lambda: ["Merci de contacter ", n(), " au ", p(), ". "],
        lambda: ["Bitte wenden Sie sich an ", n(), " unter ", p(), ". "],
        lambda: ["Contacte con ", n(), " en el ", p(), ". "],
        lambda: ["As ", n(), " noted, the lane is idle. "],
        lambda: ["Comme ", n(), " l'a noté, le bloc reste. "],
        lambda: ["Wie ", n(), " schrieb, der Block bleibt. "],
        lambda: ["Dr. ", n(), " (", p(), ") signed off the waiver. "],
        lambda: ["Mme ", n(), " (", p(), ") a signé. "],
        lambda: [n(), " will rerun the sweep on corner 3. "],
        lambda: ["The visitor form lists ", i(), " for ", n(), ". "],
        lambda: ["SSN: ", i(), ", ", p(), ". "],
        lambda: ["\n-- \n", n(), "\n", a(), "\n", p(), "\n"],
        lambda: ["\n\n", n(), "\n", a(), "\n"],
        lambda: ["Ship the board to ", a(), ". "],
        lambda: ["tel ", p(), " / ", e(), "\n"],
        lambda: ["\nFrom: ", n(), " <", e(), ">\n"],
        lambda: ["Ansprechpartner: ", n(), " <", e(), ">\n"],
        lambda: ['\n  {"name": "a", "owner": "', n(), '"},\n'],
        lambda: ["\n    owner: ", n(), "\n"],
        lambda: ["[pmu_ctrl_min] mailto:", e(), " Open point 3 stays. "],
        lambda: ["\nname,value,unit,owner\nl1_gain,0.2,V,\nl0_gain,0.104,figure,", n(), "\n\n"],
        lambda: [rng.choice(TRAPS)],
    ]


@pytest.mark.parametrize("seed", range(60))
def test_labelled_texts(seed):
    rng = random.Random(seed)
    text, want = "", []
    for _ in range(25):
        for part in rng.choice(templates(rng))():
            if isinstance(part, tuple):
                want.append((len(text), part[0], part[1]))
                part = part[1]
            text += part
    got = [(s, k, text[s:e]) for s, e, k in pii.find(text, AUTO, SET)]
    assert [g[:2] for g in got] == [w[:2] for w in want], [x for x in got if x[:2] not in {w[:2] for w in want}] + [w for w in want if w[:2] not in {g[:2] for g in got}]


def test_traps_give_nothing():
    assert pii.find("".join(TRAPS) + "\n".join(TRAPS), AUTO, SET) == []


def test_placeholders_keep_the_rest():
    text = "Please contact Alice Marwick at (303) 555-0173. The lane 7 stays."
    assert pii.redact(text, pii.find(text, AUTO, SET)) == "Please contact <NAME> at <PHONE>. The lane 7 stays."
    again = pii.redact(text, pii.find(text, AUTO, SET))
    assert pii.find(again, AUTO, SET) == []


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "\U0001f600 a@b.example", "x"), (3, "\U0001f600 a@b.example", "x"), (4, "word " * 60000 + "a@b.example", "x")], "doc_id long, text string, kind string")
    got = sorted((r.doc_id, r.kind, r.start_pos) for r in pii.find_items(df, "doc_id", "text", ("Alice",)).collect())
    assert got == [(3, "email", 2), (3, "email", 2), (4, "email", 300000)]
    red = sorted((r.doc_id, r.redacted) for r in pii.redact_column(df.where("doc_id < 4"), "doc_id", "text", ()).collect() if r.redacted is not None)
    assert red == [(2, ""), (3, "\U0001f600 <EMAIL>"), (3, "\U0001f600 <EMAIL>")]
    assert pii.find_items(df.limit(0), "doc_id", "text", ()).count() == 0


def test_too_many_names_are_refused(spark, monkeypatch):
    monkeypatch.setattr(pii, "MAX_GIVEN_NAMES", 1)
    with pytest.raises(ValueError):
        pii.listed_names(spark.createDataFrame([("A",), ("B",)], "given_name string"))


def test_queries(spark, data):
    found = p9_found(spark, data)
    assert found.columns == ["doc_id", "kind", "start_pos"] and {r.kind for r in found.select("kind").distinct().collect()} == set(pii.PLACEHOLDERS)
    assert p9_redacted(spark, data).count() == spark.read.parquet(f"{data}/documents.parquet").count()


def test_phones_with_a_slash():
    for phone in ("0351/1234567", "030/12345678", "06221/123456-78"):
        text = f"Rückfragen unter {phone}. Stand 12/05/2026, Seite 3/12."
        assert pii.find(text, AUTO, SET) == [(17, 17 + len(phone), "phone")]
        assert pii.redact(text, pii.find(text, AUTO, SET)) == "Rückfragen unter <PHONE>. Stand 12/05/2026, Seite 3/12."


def test_other_texts():
    """Hand-written cases apart from the tables' wording, by the author of the rules: 37 of 38 items, one wrong. No rule was changed because of them."""
    from tests.llm.pii_cases import parsed

    auto = pii.automaton([])
    want = {(i, *w) for i, (_, items) in enumerate(parsed()) for w in items}
    got = {(i, s, k) for i, (t, _) in enumerate(parsed()) for s, e, k in pii.find(t, auto, frozenset())}
    assert len(want & got) >= 0.95 * len(want) and len(want & got) >= 0.95 * len(got), (want ^ got)


def test_checks():
    assert pii.letter_is_valid("12345678Z") and not pii.letter_is_valid("12345678A")
    assert pii.key_is_valid("1 84 12 76 451 089 46") and not pii.key_is_valid("1 84 12 76 451 089 47")
    assert pii.insurance_is_valid("65 170839 J 003") and not pii.insurance_is_valid("65 170839 J 004")
    assert pii.iban_is_valid("DE89 3704 0044 0532 0130 00") and not pii.iban_is_valid("DE88 3704 0044 0532 0130 00")
    assert pii.card_is_valid("4111 1111 1111 1111") and not pii.card_is_valid("4111 1111 1111 1112")


def test_items_of_any_length():
    local, street = "a" * 5000, " ".join(["Old"] * 3)
    for text, item in ((f"x {local}@b.example", local), (f"To 12 {street} Road, Borford", "12")):
        (found,) = [s for s, e, k in pii.find(text, AUTO, SET)]
        assert text[found:].startswith(item)
    assert len(pii.find("1" * 200_000, AUTO, SET)) == 0 and len(pii.find("a b " * 50_000 + "-" * 200_000, AUTO, SET)) == 0
