"""Personal information in free text: anchors by Aho-Corasick, expanded and validated by local parsers.

One automaton over the text finds the anchors: at-signs and their disguises, digits, name cues, titles, given names,
reporting and acting verbs, and words and endings of street names. From each anchor a deterministic parser goes left and
right, word by word, to the borders of the item and checks it; no window of characters cuts an item.

* ``email``: local part and a domain whose last label is letters, with blanks around the at-sign or written ``[at]``,
  ``(at)``, ``[dot]`` and the like. Versions (``pkg@9.5.1``), ``HEAD@{1}``, ``@(posedge ...)`` and the user part of an
  address with a scheme (``http://u:p@host.example``) are none; ``mailto:`` isn't part of one.
* ``phone``: international with 8 to 15 digits, or in the national forms of the plans of +1, +44, +33, +49 and +34.
* ``id_number``: national identity numbers of the US, UK, Germany, France and Spain, account numbers (IBAN) and payment
  cards. What decides is evidence: an identity cue before the number or its bearer behind it ("for NAME"), else its check
  digits or letter; a number that has neither is none. Two forms stand for themselves: that of the UK, which nothing else
  has, and that of the US with an area that is never issued, as in made-up examples. Accounts and cards must pass their check.
* ``address``: a street line (number and street, or street and number) followed by its place or postcode.
* ``name``: a given name (of the parameter table, or of the common ones listed here) with a surname; initials and a
  surname before a person's verb; anything of a name's form where only a name stands: after a title or label, before
  ``<e-mail>``, as the subject of a verb that only persons are the subject of, at the head of a signature, in a table's
  column of persons, as the bearer of an identity number. No list of names is complete, so the form of the slot decides where no list does.

Each text is read where it lies; nothing is shuffled. The given names are a parameter table, checked to be small, and
travel with the tasks.

Defined results: null and empty texts give no rows and stay as they are; texts of any length are read whole; repeated
rows are reported under their own ids; of overlapping items the earlier, then the longer one counts; positions are in
characters (code points) from 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACEHOLDERS = {"email": "<EMAIL>", "phone": "<PHONE>", "id_number": "<ID_NUMBER>", "address": "<ADDRESS>", "name": "<NAME>"}

#: Largest table of given names that travels with the tasks.
MAX_GIVEN_NAMES = 200_000

AT_FORMS = ["@", "[at]", "(at)", "{at}", "<at>", "[AT]", "(AT)", "{AT}", "[ at ]", "( at )", " at ", " AT "]
#: Labels and words of address after which a person's name stands.
CUES = [
    "contact ", "Contact ", "contacter ", "Contacter ", "Contactez ", "contactez ", "wenden Sie sich an ", "Contacte con ", "contacte con ", "contactar con ", "Contactar con ",
    "Contact: ", "Reviewer: ", "Reviewed by: ", "Reported by: ", "Approved by: ", "Assigned to: ", "Assignee: ", "Owner: ", "Author: ", "Name: ", "Responsable: ", "Auteur: ", "Relecteur: ", "Nom: ",
    "Ansprechpartner: ", "Ansprechpartnerin: ", "Prüfer: ", "Prüferin: ", "Verantwortlich: ", "Gemeldet von: ", "Revisor: ", "Contacto: ", "Autor: ", "Autora: ", "Nombre: ", "Dear ", "Hi ", "Hello ",
    "From: ", "To: ", "Cc: ", "Bcc: ", "Von: ", "An: ", "De: ", "À: ", "Para: ", "owner: ", "author: ", "reviewer: ", "contact: ", "assignee: ", "maintainer: ",
    *(f'"{k}":{b}"' for k in ("owner", "author", "reviewer", "contact", "assignee", "maintainer", "name_of_owner") for b in ("", " ")),
]
TITLES = ["Dr.", "Prof.", "Mr.", "Mrs.", "Ms.", "Mr", "Mrs", "Ms", "Mme", "Mlle", "M.", "Herr", "Frau", "Sr.", "Sra.", "Srta.", "Don", "Doña"]
#: Verbs of which only a person is the subject, in forms that follow the name at once.
VERBS_EN = "said wrote noted replied asked agreed suggested explained complained promised admitted thinks believes hopes signed reviewed approved phoned emailed".split()
WILL_EN = "rerun repeat redo retry check recheck review ask call phone send write reply fix update join attend meet sign approve confirm present travel visit contact help prepare follow".split()
VERBS_FR = "a noté,a dit,a écrit,a demandé,a répondu,a signé,a approuvé,a confirmé,a relu,pense,propose,relance,répète,vérifie,relit,corrige,écrit,demande,répond,appelle,envoie,signe,confirme,note".split(",")
VERBS_DE = "sagt sagte schrieb schreibt meint meinte fragt fragte bat antwortet antwortete wiederholt prüft prüfte korrigiert ruft schickt schickte unterschreibt unterschrieb bestätigt bestätigte notierte".split()
VERBS_ES = "dijo escribió indicó señaló pidió preguntó respondió firmó aprobó confirmó revisó cree propone repetirá revisará corregirá enviará llamará firmará confirmará repite revisa corrige envía firma".split()
ACTS = [f" {v} " for v in VERBS_EN + VERBS_FR + VERBS_DE + VERBS_ES] + [f" will {v} " for v in WILL_EN] + [f" {v}{e}" for v in VERBS_EN + VERBS_FR + VERBS_DE + VERBS_ES for e in ",:.\n"] + [f" {o}{v}{e}" for v in VERBS_FR if v.startswith("a ") for o in ("l'", "l’") for e in " ,:."]
#: Capitalised words that may stand before such a subject, and words whose noun a capitalised phrase may be.
_CLAUSE = frozenset("As Comme Wie Como That Que Dass And Et Und Y But Then If".split())
_DETERMINERS = frozenset("the a an this that these those its our your their each every any some no of in on at by from with for to le la les l' un une du de des ce cette dans sur der die das den dem des ein eine einen im am el los las una del al en".split())
#: Common given names of English, French, German and Spanish that are no words of the language otherwise.
COMMON = """Aaron Abigail Adam Albert Alejandro Alexander Alfred Amanda Amelia Andrea Andreas Andrew Angela Anna Anne Anthony Antoine Antonio Arthur Barbara Benjamin Bernard Bettina
Brenda Carlos Carolin Caroline Catherine Cecilia Charlotte Christian Christine Christoph Christopher Claire Clara Cristina Cynthia Daniel Danielle David Deborah Denise Dennis Diana Diego Donald
Dorothy Eduardo Edward Eleanor Elisabeth Elizabeth Emily Emma Enrique Erika Ernesto Esther Eugene Eva Felix Fernando Florence Florian Francesca Francisco Franziska François Gabriel Gerald Gerhard
Gregory Guillaume Gustavo Hannah Hans Harriet Heather Heidi Helen Helmut Henrik Ignacio Ingrid Isabel Isabelle Jacob Jacqueline James Janet Javier Jean Jennifer Jessica Joachim Johann Johannes
John Jonas Jonathan Jorge Joseph Joshua Juan Judith Julia Justin Karl Katharina Katherine Kathleen Kenneth Kevin Klaus Laura Laurent Linda Lisa Louis Louise Lucas Luis Lukas Marcel Marco Margaret
Maria Marie Marina Markus Martha Martin Matthew Matthias Michael Michelle Miguel Monique Nadine Nathalie Nicholas Nicolas Nicole Oliver Pablo Pamela Patricia Patrick Paul Pedro Peter Philip Philippe
Pierre Rafael Ralf Raymond Rebecca Renate Ricardo Richard Robert Roberto Ronald Russell Samantha Samuel Sandra Sarah Sharon Sofia Sophie Stefan Stefanie Stephanie Stephen Steven Susan Susanne Sylvia
Theodore Theresa Thomas Timothy Tobias Ursula Valentina Valerie Vanessa Veronica Vincent Virginia Walter Werner William Wolfgang Xavier Yolanda""".split()
#: Headings of a table's columns that hold persons.
COLUMNS = "owner Owner author Author reviewer Reviewer contact Contact assignee Assignee maintainer engineer Engineer responsable Responsable Verantwortlich Prüfer revisor autor auteur".split()
STREETS_EN = ["Road", "Rd", "Street", "St", "Lane", "Ln", "Avenue", "Ave", "Drive", "Dr", "Court", "Ct", "Boulevard", "Blvd", "Place", "Square", "Terrace", "Way", "Close", "Crescent"]
STREETS_FR = ["rue", "avenue", "quai", "impasse", "boulevard", "place", "allée", "chemin", "route", "cours", "passage", "square"]
STREETS_DE = ["straße", "strasse", "str.", "weg", "allee", "platz", "gasse", "ring", "damm", "ufer", "Straße", "Weg", "Allee", "Platz"]
STREETS_ES = ["Calle", "C/", "Avda.", "Avenida", "Plaza", "Pza.", "Paseo", "Camino", "Ronda", "Carretera"]

_U, _L = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_WORD = f"[{_U}][{_L}]+(?:['’][{_U}]?[{_L}]+)?"
_SUR = f"(?:(?:Mc|Mac|O['’])?{_WORD}|[{_U}]{{2,}})(?:-(?:{_WORD}|[{_U}]{{2,}}))?"
_GIVEN = f"{_WORD}(?:-{_WORD})?"
_INITIALS = f"(?:[{_U}]\\.[ -]?){{1,3}}"
NAME = f"(?:{_INITIALS}{_SUR}|{_SUR}, (?:{_GIVEN}|{_INITIALS.rstrip()})|{_GIVEN}(?: {_INITIALS})? ?(?:(?:von|van|de|del|di) )?(?<= ){_SUR})(?![\\w'’])"
_name = re.compile(NAME)
_name_only = re.compile(f"[ \t]*({NAME})[ \t]*$")
_surname = re.compile(f" (?:{_INITIALS})?({_SUR})(?![\\w'’])")
_before_given = re.compile(f"(?<![\\w-])({_SUR}), $")
_initialled = re.compile(f"{_INITIALS}{_SUR}$")
#: Words in capitals that begin sentences and are no given names (articles, pronouns, conjunctions, prepositions).
_NO_NAME = frozenset("Comme Wie Como Que Dass Aber Mais Pero The A An This That These Those It Its If In On At As After Before When While Because Unless Each Every Both All Any Some No Not For From To With Without And But Or So Then Le La Les Un Une Des Si Dans Sur Avec Der Die Das Ein Eine Wenn Bei Nach Vor Im Am El Los Las Una Cuando En Con Por Para".split())
_domain = re.compile(r" ?(\w(?:[\w\-]*\w)?(?:\.\w(?:[\w\-]*\w)?)*\.[^\W\d_]{2,24})(?![\w\-])")
_dot = r"(?: ?[\[({<] ?(?:dot|DOT|punto|point|punkt) ?[\])}>] ?| (?:dot|DOT) |\.)"
_veiled = re.compile(rf" ?(\w[\w\-]*(?:{_dot}\w[\w\-]*)*{_dot}[^\W\d_]{{2,24}})(?![\w\-])")
_bare = re.compile(r"(\w[\w\-]*(?: (?:dot|DOT) \w[\w\-]*)* (?:dot|DOT) [^\W\d_]{2,24})(?![\w\-])")

_run = re.compile(r"[+(]*\d[\d ()./\-]*")
_phone = re.compile(
    r"""(?<![\w.+\-/@\#:])(?:
      \+\d{1,3}(?:[ .\-]?\(\d{1,4}\))?(?:[ .\-]?\d{1,9}){1,6}
     |00\d{2}[ .\-]\d{1,4}(?:[ .\-]\d{2,8}){1,3}
     |\(\d{3,5}\)[ ]?\d{3,6}(?:[ .\-]?\d{3,4})?
     |1[ .\-]?[2-9]\d{2}[ .\-][2-9]\d{2}[ .\-]\d{4}
     |[2-9]\d{2}[.\-][2-9]\d{2}[.\-]\d{4}
     |1[2-9]\d{2}[2-9]\d{6}
     |0[1-9](?:([ .\-])\d{2})(?:\1\d{2}){3}
     |0\d{3}[ ]\d{3}[ ]\d{4}|0\d{4}[ ]\d{6}|0\d{4}[ ]\d{3}[ ]\d{3}
     |0\d{2,4}[ /\-]\d{4,8}(?:[ \-]\d{2,4})?
     |[679]\d{2}([ \-])\d{3}\2\d{3}
    )(?![\w]|[.\-]\d|[ ]\d{2,}(?!\d*:))""",
    re.VERBOSE,
)
_ids = re.compile(
    r"""(?<![\w.\-])(?:
      (?P<us>\d{3}([\- ])\d{2}\2\d{4})
     |[A-Z]{2}(?P<s>[ ]?)\d{2}(?P=s)\d{2}(?P=s)\d{2}(?P=s)[A-D]
     |\d{2}(?P<g>[ ]?)\d{6}(?P=g)[A-Z](?P=g)\d{3}
     |\d{8}-?[A-Z]
     |[1-478](?P<f>[ ]?)\d{2}(?P=f)\d{2}(?P=f)[\dAB]{2}(?P=f)\d{3}(?P=f)\d{3}(?P=f)\d{2}
    )(?![\w]|-\d)""",
    re.VERBOSE,
)
#: What says that an identity number follows; between it and the number there may be a linking word.
ID_CUES = """SSN|social security|social security number|NINO|national insurance|national insurance number|ID|id|ID card|identity|identity number|identity card|passport|passport number|tax id|personal|NIR|sécurité sociale|identité|carte d'identité|passeport
|Ausweis|Ausweisnr|Ausweisnummer|Personalausweis|Personalausweisnummer|Reisepass|Sozialversicherungsnummer|Rentenversicherungsnummer|Steuer-ID|DNI|NIE|NIF|identidad|pasaporte|IBAN|card|card number|Karte|carte|tarjeta""".replace("\n", "").split("|")
_link = r"(?:[ ]?(?:no\.?|nr\.?|n[°º]|num\.?|number|numéro|Nummer|número|is|was|are|ist|lautet|est|es|[:=#])){0,3}[ ]*$"
_id_cue = re.compile(r"(?<![\w])(?:" + "|".join(sorted(map(re.escape, ID_CUES), key=len, reverse=True)) + r")\.?" + _link, re.IGNORECASE)
#: What says that a number is one of another kind.
_not_id = re.compile(r"(?<!\w)(?:ticket|tickets|part|part no\.?|part number|build|rev\.?|revision|issue|order|serial|version|replaces|line|page|note|change|commit|checksum|addr|address 0x)[ #:]*$", re.IGNORECASE)
_iban = re.compile(r"(?<![\w])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![\w])")
_card = re.compile(r"(?<![\w.\-])(?:\d{4}([ \-])\d{4}\1\d{4}\1\d{1,7}|3[47]\d{2}[ \-]\d{6}[ \-]\d{5})(?![\w]|-\d)")
_for = re.compile(rf"[ ](?:for|pour|für|para)[ ]({NAME})")

_place = rf"(?:[ ]?[,\n][ \t]*(?:Apt|Unit|Floor|Suite|Flat|Room)\.?[ ]\w{{1,5}})?[ ]?[,\n][ \t]*[{_U}][\w'’\-]+"
_street_en = re.compile(rf"(?<![\w.,\-])(\d{{1,5}}[A-Za-z]?[ ](?:[{_U}][\w'’\-]*[ ]){{1,4}}?(?:{'|'.join(STREETS_EN)})\b\.?(?:[ ](?:N|S|E|W|NE|NW|SE|SW))?{_place}(?:,?[ ](?:[A-Z]{{2}}[ ]\d{{5}}|[A-Z]{{1,2}}\d[\dA-Z]?[ ]\d[A-Z]{{2}}))?)")
_code = rf"[ ]?[,\n][ \t]*\d{{5}}[ ][{_U}][\w'’\-]+"
_street_fr = re.compile(rf"(?<![\w.\-])(\d{{1,5}}(?:[ ]?(?:bis|ter|quater))?,?[ ](?:{'|'.join(STREETS_FR)})[ ](?:(?:de|du|des|la|le|les)[ ]|[dl]['’])*[{_U}][\w'’ \-]*?{_code})")
_street_de = re.compile(rf"(?<![\w\-])([{_U}][\w\-]*(?:[ ][{_U}][\w\-]*)?(?:{'|'.join(re.escape(s) for s in STREETS_DE)})[ ]\d{{1,4}}[ ]?[a-z]?{_code})")
_street_es = re.compile(rf"(?<![\w\-])((?:{'|'.join(re.escape(s) for s in STREETS_ES)})[ ]?(?:(?:de|del|la|las|los|el)[ ])*[{_U}][\w'’ \-]*?,?[ ]\d{{1,4}}{_code})")


def automaton(given: list[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in (
        ("given", sorted({*given, *COMMON})),
        ("act", sorted(set(ACTS))),
        ("digit", "0123456789"),
        ("column", COLUMNS),
        ("at", AT_FORMS),
        ("cue", CUES),
        ("title", [t + " " for t in TITLES]),
        ("en", [f" {w}" for w in STREETS_EN]),
        ("fr", [f" {w} " for w in STREETS_FR]),
        ("de", [f"{w} " for w in STREETS_DE]),
        ("es", STREETS_ES),
    ):
        for w in words:
            old = a.get(w, ())
            a.add_word(w, (*old, (kind, w)))
    a.make_automaton()
    return a


def _back(text: str, at: int, words: int) -> list[int]:
    """Where the last words before `at` begin, on the same line and one blank apart: the nearest first."""
    out = []
    while len(out) < words and at > 0 and text[at - 1] == " ":
        at -= 1
        end = at
        while at and not text[at - 1].isspace():
            at -= 1
        if at == end:
            break
        out.append(at)
    return out


def _email(text: str, at: int, form: str) -> tuple[int, int] | None:
    """The e-mail address around the at-sign (or its disguise) text[at : at + len(form)]."""
    start = end = at - 1 if text[at - 1 : at] == " " else at
    while start and (text[start - 1].isalnum() or text[start - 1] in "_.%+-"):
        start -= 1
    while start < end and text[start] in ".%+-":
        start += 1
    if not any(c.isalnum() for c in text[start:end]) or not (text[end - 1].isalnum() or text[end - 1] == "_"):
        return None
    before = start
    while before and not text[before - 1].isspace():
        before -= 1
    if "://" in text[before:start]:  # the user part of an address with a scheme
        return None
    after = at + len(form)
    spaced = text[at - 1 : at] == " "
    if form == "@":
        if spaced != (text[after : after + 1] == " "):
            return None
        m = _domain.match(text, after)
    elif form[0] == " ":
        m = _bare.match(text, after)
    else:
        m = _veiled.match(text, after)
    return (start, m.end(1)) if m else None


def _line(text: str, at: int) -> tuple[int, int]:
    end = text.find("\n", at)
    return text.rfind("\n", 0, at) + 1, len(text) if end < 0 else end


def _column(text: str, at: int, end: int) -> list[tuple[int, int]]:
    """The names in the column of a delimited table that is headed by text[at:end]; none where that heads no column."""
    begin, stop = _line(text, at)
    mark = next((c for c in (text[at - 1 : at] if at > begin else "", text[end : end + 1]) if c in set(",;\t|")), "")
    if not mark or (at > begin and text[at - 1] != mark) or (end < stop and text[end] != mark):
        return []
    out, width, number = [], text.count(mark, begin, stop), text.count(mark, begin, at)
    while stop < len(text):
        begin, stop = _line(text, stop + 1)
        cells = text[begin:stop].split(mark)
        if mark == "," and len(cells) == width + 2 and _name_only.match(f"{cells[number]},{cells[number + 1]}"):
            cells[number : number + 2] = [f"{cells[number]},{cells[number + 1]}"]  # a surname before its given name
        if len(cells) != width + 1:
            break
        if m := _name_only.match(cells[number]):
            first = begin + sum(map(len, cells[:number])) + number
            out.append((first + m.start(1), first + m.end(1)))
    return out


def _name_before(text: str, end: int) -> tuple[int, int] | None:
    """The longest name that ends at `end`, of up to five words."""
    first = end
    while first and not text[first - 1].isspace():
        first -= 1
    best = None
    for start in [first, *_back(text, first, 4)]:
        m = _name.match(text, start)
        if m and m.end() == end and text[start:].split(" ", 1)[0].rstrip(",") not in _NO_NAME:
            best = (start, end)
    return best


def _subject(text: str, at: int) -> bool:
    """Whether a name's form at a position can be a subject of its own: not the rest of a phrase of things ("the Clock Tree")."""
    begins = _back(text, at, 1)
    word = text[begins[0] : at - 1] if begins else ""
    return not (word.lower() in _DETERMINERS or (word[:1].isupper() and word[-1:].isalnum() and word not in _CLAUSE))


def find(text: str, auto: ahocorasick.Automaton, given: frozenset[str]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every item of a text, in order, without overlaps."""
    got: list[tuple[int, int, str]] = []
    names: list[tuple[int, int]] = []
    runs: list[tuple[int, int]] = []
    ran = 0
    for last, hits in auto.iter(text):
        for kind, word in hits:
            at = last + 1 - len(word)
            if kind == "at":
                if span := _email(text, at, word):
                    got.append((*span, "email"))
                    if text[span[0] - 1 : span[0]] == "<":
                        edge = span[0] - 1
                        while edge and text[edge - 1] in " \t":
                            edge -= 1
                        if head := _name_before(text, edge):
                            names.append(head)
            elif kind == "digit":
                if at >= ran:
                    begin = at
                    while begin and text[begin - 1] in "+(":
                        begin -= 1
                    run = _run.match(text, begin)
                    ran = run.end()
                    runs.append(run.span())
            elif kind == "cue":
                if at and (text[at - 1].isalnum() or text[at - 1] in "_-"):
                    continue
                if (m := _name.match(text, last + 1)) and text[last + 1 :].split(" ", 1)[0] not in _NO_NAME:
                    names.append(m.span())
            elif kind == "column":
                names += _column(text, at, last + 1)
            elif kind == "title":
                if (not at or not (text[at - 1].isalnum() or text[at - 1] in "_-")) and (m := _name.match(text, last + 1)):
                    names.append(m.span())
            elif kind == "act":
                span = _name_before(text, at)
                if span and (_subject(text, span[0]) or _initialled.match(text, span[0], span[1])):
                    names.append(span)
            elif kind == "given":
                if (at and (text[at - 1].isalnum() or text[at - 1] in "_-@.+")) or text[last + 1 : last + 2].isalnum():
                    continue
                reversed_ = None
                if text[at - 2 : at] == ", ":
                    first = at - 2
                    while first and not text[first - 1].isspace():
                        first -= 1
                    reversed_ = _before_given.match(text, first, at)
                m = _surname.match(text, last + 1)
                if m and not reversed_:
                    names.append((at, m.end()))
                elif reversed_:
                    names.append((reversed_.start(), last + 1))
            elif kind == "en":
                for start in reversed(_back(text, at + 1, 5)):  # the number and up to four words
                    if m := _street_en.match(text, start):
                        if m.start() < at < m.end():
                            got.append((*m.span(1), "address"))
                            break
            elif kind == "fr":
                for start in reversed(_back(text, at + 1, 2)):
                    if (m := _street_fr.match(text, start)) and m.start() < at < m.end():
                        got.append((*m.span(1), "address"))
                        break
            elif kind == "de":
                first = at
                while first and (text[first - 1].isalnum() or text[first - 1] in "_-"):
                    first -= 1
                for start in [*_back(text, first, 1), first]:
                    if (m := _street_de.match(text, start)) and m.start() < at < m.end():
                        got.append((*m.span(1), "address"))
                        break
            elif kind == "es":
                if m := _street_es.match(text, at):
                    got.append((*m.span(1), "address"))
    for begin, end in runs:
        if end - begin < 6:
            continue
        for m in _phone.finditer(text, begin, min(len(text), end + 6)):
            digits = sum(c.isdigit() for c in m[0])
            if 8 <= digits <= 15 and not _kind_before(_not_id, text, m.start()):
                start = m.start()
                if text[start] == "(" and ")" not in m[0]:
                    continue
                got.append((start, m.end(), "phone"))
        for m in _ids.finditer(text, max(0, begin - 3), min(len(text), end + 12)):
            if m.start() <= end:
                got += _identity(text, m, names)
        for pattern, check in ((_iban, iban_is_valid), (_card, card_is_valid)):
            for m in pattern.finditer(text, max(0, begin - 2), min(len(text), end + 40)):
                if m.start() <= begin and check(m[0]):
                    got.append((*m.span(), "id_number"))
    for start, _, kind in [g for g in got if g[2] in ("address", "phone")]:
        # the line above a street line or a telephone line is the head of a signature, if it has a name's form
        line, _ = _line(text, start)
        if line and not text[line:start].strip():
            above = text.rfind("\n", 0, line - 1) + 1
            if m := _name_only.match(text, above, line - 1):
                if kind == "address" or text[:above].endswith("-- \n"):
                    names.append(m.span(1))
    for m in _signature.finditer(text):
        names.append(m.span(1))
    got += [(*n, "name") for n in names]
    got.sort(key=lambda g: (g[0], -g[1]))
    out: list[tuple[int, int, str]] = []
    for g in got:
        if not out or g[0] >= out[-1][1]:
            out.append(g)
    return out


_signature = re.compile(f"(?m)^-- ?\n[ \t]*({NAME})[ \t]*$")


def _kind_before(pattern: re.Pattern, text: str, at: int) -> bool:
    """Whether the words before a number, on its line and up to eight of them, say of what kind it is."""
    begins = _back(text, at, 8)
    return bool(begins and pattern.search(text, begins[-1], at)) or bool(at and not text[at - 1].isspace() and pattern.search(text, max(0, at - 60), at))


def letter_is_valid(number: str) -> bool:
    """The check letter of a Spanish identity number: the rest of the division by 23."""
    digits = "".join(filter(str.isdigit, number))
    return number[-1] == "TRWAGMYFPDXBNJZSQVHLCKE"[int(digits) % 23]


def key_is_valid(number: str) -> bool:
    """The key of a French social security number: 97 less the rest of the division by 97; Corsica counts as 19 and 18."""
    digits = number.replace(" ", "").replace("2A", "19").replace("2B", "18")
    return digits.isdigit() and int(digits[-2:]) == 97 - int(digits[:-2]) % 97 and (1 <= int(digits[3:5]) <= 12 or int(digits[3:5]) >= 20)


def insurance_is_valid(number: str) -> bool:
    """The check digit of a German insurance number: weighted cross sums, the letter as its two-digit place."""
    flat = "".join(c if c.isdigit() else f"{ord(c) - 64:02d}" for c in number if c.isalnum())
    total = sum(sum(map(int, str(int(c) * w))) for c, w in zip(flat[:-1], (2, 1, 2, 5, 7, 1, 2, 1, 2, 1, 2, 1)))
    return total % 10 == int(flat[-1]) and 1 <= int(flat[2:4]) <= 31 and 1 <= int(flat[4:6]) <= 12


def iban_is_valid(number: str) -> bool:
    flat = number.replace(" ", "")
    return 15 <= len(flat) <= 34 and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def card_is_valid(number: str) -> bool:
    """The check digit of a payment card: every second digit from the right counts double, as its cross sum."""
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return 13 <= len(digits) <= 19 and (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def _identity(text: str, m: re.Match, names: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    if _kind_before(_not_id, text, m.start()):
        return []
    number = m[0]
    bearer = _for.match(text, m.end())
    sure = bool(bearer) or _kind_before(_id_cue, text, m.start())
    if m["us"]:
        sure = sure or number[:3] in ("000", "666") or number[0] == "9"
    elif number[0].isalpha():
        sure = True  # the UK's form
    elif m["f"] is not None:
        sure = sure or key_is_valid(number)
    elif m["g"] is not None:
        sure = sure or insurance_is_valid(number)
    else:
        sure = sure or letter_is_valid(number)
    if not sure:
        return []
    if bearer:
        names.append(bearer.span(1))
    return [(*m.span(), "id_number")]


def redact(text: str, items: list[tuple[int, int, str]]) -> str:
    """The text with every item replaced by its placeholder."""
    out, at = [], 0
    for start, end, kind in items:
        out += [text[at:start], PLACEHOLDERS[kind]]
        at = end
    return "".join(out) + text[at:]


_finders: dict[tuple, tuple] = {}


def _finder(given: tuple[str, ...]):
    if given not in _finders:
        _finders.clear()
        _finders[given] = automaton(list(given)), frozenset(given)
    return _finders[given]


def listed_names(table: DataFrame, col: str = "given_name") -> tuple[str, ...]:
    """The given names as a parameter; refused if there are too many to travel with the tasks."""
    names = table.select(F.trim(col).alias("n")).where("n != ''").distinct().limit(MAX_GIVEN_NAMES + 1).collect()
    if len(names) > MAX_GIVEN_NAMES:
        raise ValueError(f"more than {MAX_GIVEN_NAMES} given names")
    return tuple(sorted(r.n for r in names))


def find_items(df: DataFrame, id_col: str, text_col: str, given: tuple[str, ...]) -> DataFrame:
    """(id, kind, start_pos, end_pos) of every item."""
    kind_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, names = _finder(given)
        for batch in batches:
            rows: list[int] = []
            items: list[tuple[int, int, str]] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text:
                    found = find(text, auto, names)
                    rows += [i] * len(found)
                    items += found
            if items:
                starts, ends, kinds = zip(*items)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(kinds), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["a", "b", "c", "d"])

    return df.select(id_col, text_col).mapInArrow(run, f"a {kind_type}, b string, c bigint, d bigint").toDF(id_col, "kind", "start_pos", "end_pos")


def redact_column(df: DataFrame, id_col: str, text_col: str, given: tuple[str, ...], out_col: str = "redacted") -> DataFrame:
    """(id, text with placeholders) of every row."""
    kind_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, names = _finder(given)
        for batch in batches:
            out = [t and redact(t, find(t, auto, names)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["a", "b"])

    return df.select(id_col, text_col).mapInArrow(run, f"a {kind_type}, b string").toDF(id_col, out_col)
