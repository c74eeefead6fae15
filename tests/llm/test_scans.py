"""Scanned pages: clean text is wrapped, cut, misread and framed with furniture here, so that every true case is known."""

import random
import re
from collections import Counter

import pytest

from foliate.llm import scans
from foliate.llm.queries import p5_found, p5_repaired

NOUNS = "clock reset fuse lane bridge timer packet mask offset field monitor register pipeline descriptor multiplexer oscillator threshold amplifier substrate".split()
VERBS = "blocks routes samples throttles validates releases overrides captures forwards extends".split()
ADJECTIVES = "early late measured internal external derived pending stale narrow shallow synchronous persistent".split()
COMPOUNDS = ["real-time", "power-down", "edge-triggered", "on-chip"]


def sentence(rng):
    w = rng.choice
    return f"{w(['Because', 'While', 'After'])} the {w(ADJECTIVES)} {w(NOUNS)} {w(VERBS)} the {w(NOUNS)}, {w(['Palmarren', 'Korselgru4', 'TMR_MASK_LO', '0x3A' + str(rng.randrange(10, 99))])} {w(VERBS)} {rng.randrange(4000)} {w(ADJECTIVES)} {w(NOUNS)} and the {w(COMPOUNDS)} {w(NOUNS)} {w(VERBS)} with the {w(NOUNS)}."


def scanned(seed, feed):
    """A text with its cases; feed: form feeds begin the pages, else there are blank lines between paragraphs."""
    rng = random.Random(seed)
    mark, width, per_page = rng.choice(["-", "¬", "- "]), rng.randrange(50, 80), rng.randrange(18, 26)
    header = f"{rng.choice(['Dorlenmar', 'Vormelkor'])} {rng.choice(['Global', 'Narrow'])} {rng.choice(NOUNS)} table"
    second = rng.choice([None, "Not for release"])
    number = rng.choice([lambda n: f"- {n} -", lambda n: f"[{n}/9]", lambda n: f"Page {n} of 9", lambda n: str(n), lambda n: f"p. {n}", lambda n: f"ROSBEN  Rev. B          {n}"])
    out, want, page, on_page = [], set(), 1, 0

    def put(text, kinds=()):
        nonlocal page, on_page
        out.append(text)
        want.update((len(out) - 1, k) for k in kinds)
        on_page += 1
        if on_page == per_page:
            on_page = 0
            for t in [number(page), ("\f" if feed else "") + noisy(header), *([second] if second else [])]:
                out.append(t)
                want.add((len(out) - 1, "furniture"))
            page += 1

    def noisy(text):
        return text.replace("o", "0", 1) if rng.random() < 0.2 else text

    out.append(header)
    want.add((0, "furniture"))
    if second:
        out.append(second)
        want.add((1, "furniture"))
    while page < 5:
        paragraph = " ".join(sentence(rng) for _ in range(rng.randrange(1, 5)))
        line, words, bad = "", paragraph.split(" "), set()

        def kinds(line):
            return ["ocr"] * bool(bad & set(re.split("[ .,]+", line)))

        while words:
            word = words.pop(0)
            if re.fullmatch("[a-z]{4,}", word) and rng.random() < 0.03:
                swaps = [x for x in [("e", "c"), ("o", "0"), ("l", "1"), ("s", "5"), ("m", "rn"), ("h", "b"), ("t", "f"), ("d", "cl"), ("a", "@"), ("u", "ii")] if x[0] in word]
                if swaps:
                    word = word.replace(*rng.choice(swaps), 1)
                    bad.add(word)
            if len(line) + len(word) + 1 <= width:
                line += (" " if line else "") + word
                continue
            room = width - len(line) - 2
            if re.fullmatch(r"[a-z]{6,}", word) and word not in bad and 3 <= room < len(word) - 2:
                put(line + " " + word[:room] + mark, ["hyphen", *kinds(line)])
                line = word[room:]
            elif re.fullmatch("[a-z]+-[a-z]+", word) and room > word.index("-") + 1:
                cut = word.index("-") + 1
                put(line + " " + word[:cut], kinds(line))
                line = word[cut:]
            else:
                put(line, kinds(line))
                line = word
        put(line, kinds(line))
        if not feed:
            put("")
        elif rng.random() < 0.3:
            put("Applies to all corners.")
            for _ in range(rng.randrange(3)):
                put(str(rng.randrange(60)))
    return "\n".join(out), want


def corpus(times=1):
    rng = random.Random(99)
    texts = ["\n".join(sentence(rng) for _ in range(3000))] + [scanned(s, s % 2)[0] for s in range(20)]
    return texts * times


def facts_of(spark, pages, times=1):
    """The facts of the corpus with some more pages, as the tasks have them."""
    table = scans.FactTable(spark.createDataFrame([(t,) for t in corpus(times) + pages * times], "t string"))
    rows = [(r.key, [(w.cost, w.n, w.word) for w in r.words]) for r in table.rows.collect()]
    return scans.Facts(table.total, rows)


PLAIN = "After the early timer blocks the clock, the stale bridge routes the packet."
SHORT = [
    PLAIN.replace("packet", "p@cket"), PLAIN.replace("bridge", "bridgc"), "Vormelkor eariy.",
    "After the Oscillat0r blocks the clock, Pipclinc and Descript0r stay. Bccause the Threshold extends the Regi5ter, it blocks.",
    "Vormelkor blocks the Palmarren.", "The tirner b10ck5 the rnernory and the m0nit0r lane.",
]


@pytest.fixture(scope="module")
def facts(spark):
    return facts_of(spark, SHORT + [scanned(s, f)[0] for s in range(40) for f in (False, True)])


@pytest.mark.parametrize("feed", [False, True])
def test_made_scans(facts, feed):
    hits = Counter()
    for seed in range(40):
        text, want = scanned(seed, feed)
        got = set(scans.Page(text, facts).cases())
        for kind in ("furniture", "hyphen", "ocr"):
            w, g = {x for x in want if x[1] == kind}, {x for x in got if x[1] == kind}
            hits[kind, "both"] += len(w & g)
            hits[kind, "missed"] += len(w - g)
            hits[kind, "wrong"] += len(g - w)
    for kind in ("furniture", "hyphen", "ocr"):
        assert hits[kind, "both"] > 150, hits
        assert hits[kind, "missed"] <= 0.03 * hits[kind, "both"] and hits[kind, "wrong"] <= 0.03 * hits[kind, "both"], hits


def test_clean_text_has_no_cases(facts):
    rng = random.Random(5)
    text = "\n\n".join(sentence(rng) for _ in range(60)) + "\n\n- 1\n- 2\n\n7\n8\n9\n"
    assert scans.Page(text, facts).cases() == []
    assert scans.Page(text, facts).repaired() == text


SPLIT = "Dorlen Global table\nThe early mul-\ntiplexer bl0cks the real-\ntime clock and the oscil-\n- 1 -\nDorlen Global table\nlator wbile the timer samples the\nfuse.\n\n## Head\n\nThe lane.\n- 2 -\nDorlen Global table\n"


def test_repair_gives_paragraphs(spark):
    got = scans.Page(SPLIT, facts_of(spark, [SPLIT])).repaired()
    assert "early multiplexer blocks the real-time clock and the oscillator" in got.replace("real- time", "real-time") and "Dorlen" not in got and "- 1 -" not in got and "\n## Head\n" in got


def test_distance_and_forms():
    assert scans.distance("clock", "clock") == 0 and scans.distance("cl0ck", "clock") == 0.3 and scans.distance("rnask", "mask") == 0.35 and scans.distance("zlock", "clock") > scans.FARTHEST
    assert scans.forms("rna", scans._SEEN_UNITS, 1) == {"rna", "_a", "r_a", "rn_"}
    assert scans.seen_forms("1111111111111111111111") == set() and scans.seen_forms("b@d") == {"bad"}


def test_count_terms_against_patterns():
    texts = ["The clock holds the clock-lane", "On-chip Lanes hold 0x3f and bl0ck p@th; caf\u00e9 na\u0308ive a_b re\u00adset", "", "the mul-\ntiplexer and the oscil\u00ac \n lator", "x" * 50, "\U0001f600 end"]
    got = {(t, k): n for t, k, n in scans.count_terms(texts)}
    words = Counter(m[0].lower() for t in texts[:3] + texts[4:] for m in scans._token.finditer(t) if len(m[0]) > 1)
    words.update(["the", "and", "the"])  # not the halves
    assert {t: n for (t, k), n in got.items() if k == scans.TOKEN} == dict(words)
    assert got["clock-lane", scans.COMPOUND] == 1 and ("mul-tiplexer", scans.COMPOUND) not in got and got["holds the", scans.PAIR] == 1
    assert scans.count_terms(["", " \n"]) == []
    assert scans.cut_terms(texts[3]) >= {"multiplexer", "mul-tiplexer", "mul", "oscillator"}


def test_candidates_against_all_words(spark):
    rng = random.Random(3)
    words = {w: rng.randrange(20, 900) for w in NOUNS + VERBS + ADJECTIVES + ["memory", "minimum", "hand", "band", "the"]}
    tokens: dict[str, int] = {}
    for w in sorted(words):
        for _ in range(25):
            t = w
            for _ in range(rng.randrange(1, 4)):
                seen, true = rng.choice(sorted(scans.CONFUSIONS))
                t = t.replace(true, seen, 1)
            tokens[t] = rng.randrange(0, 4)
    rows = [(t, scans.TOKEN, n) for t, n in {**tokens, **words}.items()]
    table = spark.createDataFrame(rows, "term string, kind tinyint, n bigint")
    got = {(r.term, w.word) for r in scans.candidates(table).collect() for w in r.words}
    counts = {**tokens, **words}
    want = {
        (t, w) for t, n in counts.items() for w, m in words.items()
        if t != w and len(t) > 2 and m >= scans.RATIO * max(1, n) and (c := scans.distance(t, w)) <= scans.FARTHEST and (c < 0.5 or len(t) > 4)
    }
    assert got == want and len(want) > 300


def test_context_picks_among_candidates(spark):
    texts = ["left hand " * 300 + "wide band " * 300 + "hand " * 100 + "band " * 100, "wide 6and", "left 6and"]
    f = facts_of(spark, texts)
    assert f.correct("6and", "wide") == ("band", True)


@pytest.mark.parametrize("field", ["cases", "repaired"])
def test_joined_facts_give_the_same(spark, monkeypatch, field):
    texts = SHORT + [SPLIT, SPLIT] + [scanned(s, s % 2)[0] for s in range(4)] + [None, "", " "]
    df = spark.createDataFrame([(str(i), t, i) for i, t in enumerate(texts)], "k string, t string, facts int")
    more = spark.createDataFrame([(t,) for t in corpus()], "t string").unionByName(df.select("t"))

    def run():
        table = scans.FactTable(more)
        out = scans.scan_cases(df, "t", "k", "t", table) if field == "cases" else scans.repaired_column(df, "k", "t", table)
        return bool(table.shipped), sorted(map(str, out.collect()))

    shipped, plain = run()
    monkeypatch.setattr(scans, "MAX_FACTS", 0)
    joined, same = run()
    assert shipped and not joined and plain == same and len(plain) >= len(texts)


def test_a_larger_corpus_changes_nothing(spark, facts):
    pages = SHORT + [scanned(s, s % 2)[0] for s in range(12)]
    large = facts_of(spark, SHORT + [scanned(s, f)[0] for s in range(40) for f in (False, True)], times=10)
    assert [scans.Page(t, large).cases() for t in pages] == [scans.Page(t, facts).cases() for t in pages]


def test_queries(spark, data):
    found = p5_found(spark, data)
    rows = [tuple(r) for r in found.collect()]
    assert found.columns == ["field", "rec_key", "line_no", "kind"] and len(rows) == len(set(rows))
    assert {r[3] for r in rows} == {"furniture", "hyphen", "ocr"}
    lanes = {r.doc_id: r.lane for r in spark.read.parquet(f"{data}/document_md.parquet").select("doc_id", "lane").collect()}
    assert all(lanes[r[1]] == "pdf" for r in rows if r[0] == "body_md")
    bodies = spark.read.parquet(f"{data}/document_md.parquet").select("doc_id").distinct().count()
    assert p5_repaired(spark, data).where("field = 'body_md'").count() == bodies


def test_one_finding_is_enough(facts):
    for bad in SHORT[:2]:  # a mark; a neighbour that speaks for the word
        assert scans.Page(bad, facts).cases() == [(0, "ocr")] and scans.Page(bad, facts).repaired() == PLAIN
    pages = f"Dorlenmar Global table\n{SHORT[0]}\n\fDorlenmar Global table\n{PLAIN}"
    assert scans.Page(pages, facts).cases() == [(0, "furniture"), (1, "ocr"), (2, "furniture")]
    numbers = f"{PLAIN}\nPage 1 of 2\n\f{PLAIN}\nPage 2 of 2"
    assert scans.Page(numbers, facts).cases() == [(1, "furniture"), (3, "furniture")]
    assert scans.Page(SHORT[2], facts).cases() == []  # by letters alone, and no neighbour speaks for it


def test_capitalised_words(facts):
    good = "After the Oscillator blocks the clock, Pipeline and Descriptor stay. Because the Threshold extends the Register, it blocks."
    page = scans.Page(SHORT[3], facts)
    assert page.cases() == [(0, "ocr")] and page.repaired() == good
    assert scans.Page(SHORT[4], facts).cases() == []
    assert scans.Page(SHORT[5], facts).repaired() == "The timer blocks the rnernory and the monitor lane."  # memory is no word of this corpus
