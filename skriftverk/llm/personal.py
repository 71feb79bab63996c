"""Problem 3: personal information in free text, as typed placeholders.

Regular expressions propose spans, checksum validators (Luhn, mod 11, mod 31, mod 97) confirm or reject them, and words
near a span move its score; spans of score 1 or more count. Overlaps go to the better score, then to the earlier start.

Names need a lexicon. It starts from a list of given names and grows over the whole corpus in two distributed counts:
words that follow listed given names give surnames and surname parts; words that stand before those surnames give
further given names. The lexicon holds words of names, not people; its size is checked before it is sent to the workers.

Null, empty and blank texts have no span. Positions are code points.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .common import chunks

GAP = r"[\s\xad​]"
#: Words of streets, lower case; a name of a street ends in one of them.
STREET_ENDS = """vägen väg gatan gata gränden gränd stigen stig torget torg backen backe allén allé leden platsen plats plan kroken krok svängen
stråket gången kajen brinken slingan liden rundeln höjden tunet kullen parken platån veien vei gaten gate plass bakken stien alleen tunet
katu tie kuja polku straße strasse weg platz gasse ring allee ufer damm steig str""".split()
FARM = "övre nedre norra södra östra västra lilla stora gamla nya yttre inre mellersta".split()
#: Words that name roads by number, and so no address.
ROADS = "väg vägen länsväg riksväg europaväg landsväg väg plan våning etapp lagerplats parkeringsplats sittplats ståplats".split()
BEFORE_STREETS = "bosatt på adress till in bor fastigheten der vid i from at an osoite nouto abholung hentes hämtas".split()
NOT_IDS = """ärende ärendenr ärendenummer diarienummer dnr kurskod kurs org orgnr organisationsnummer artikelnummer artikel best.nr ordernr faktura
fakturanr fakturanummer bankgiro plusgiro postgiro konto kontonr isbn issn ocr serienr serienummer kundnr version mätaren modell reg.nr kod varunr
parti partinr sak saksnr asia viite""".split()
PHONE_WORDS = """tel telefon tfn telefonnummer mobil mobilnr ring ringa nås når sms sms:a fax telefon/fax jour växel puhelin puh phone call mob
soita telefonnr ringen anruf appelez telefoon""".split()
ID_WORDS = """personnummer pnr person-nr personnr samordningsnummer födelsenummer fødselsnummer fnr henkilötunnus hetu sökande undertecknad intyget
registret nr number form patient personal""".split()
TITLES = """hr herr fru fröken dr doktor prof professor lektor mr mrs ms miss frau monsieur madame familjen fam släkten bröderna systrarna firma
ab stiftelsen bolaget föreningen kören klubben laget firman teatern skolan museet bandet orkestern gruppen kvartetten trion fonden priset
huset gården galleriet bageriet byrån verkstaden undertecknad kassör ordförande sekreterare enligt foto text kontakt""".split()


def luhn(d: str) -> bool:
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def mod97(account: str) -> bool:
    """International account numbers: no personal number is cut out of one."""
    s = re.sub(r"\s", "", account).upper()
    return len(s) > 14 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def is_date(year: int, month: int, day: int) -> bool:
    leap = year % 4 == 0 and (year % 100 != 0 or year % 400 == 0)
    return 1 <= month <= 12 and 1 <= day <= [31, 29 if leap else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][month - 1]


def swedish_id(d: str) -> bool:
    """Ten or twelve digits: a date (coordination numbers add 60 to the day) and a Luhn digit."""
    year, m, day = int(d[:-8]), int(d[-8:-6]), int(d[-6:-4])
    day -= 60 if day > 60 else 0
    years = [year] if len(d) == 12 else [1900 + year, 2000 + year]
    return luhn(d[-10:]) and any(1850 <= y <= 2100 and is_date(y, m, day) for y in years)


def norwegian_id(d: str) -> bool:
    """Eleven digits: day (+40), month (+40, +80 in test series) and two mod-11 digits."""
    day, m, y = int(d[:2]), int(d[2:4]), int(d[4:6])
    day -= 40 if day > 40 else 0
    m -= 80 if m > 80 else 65 if m > 65 else 40 if m > 40 else 0
    x = list(map(int, d))
    k1 = 11 - sum(a * b for a, b in zip(x, (3, 7, 6, 1, 8, 9, 4, 5, 2))) % 11
    k2 = 11 - sum(a * b for a, b in zip(x, (5, 4, 3, 2, 7, 6, 5, 4, 3, 2))) % 11
    return (is_date(1900 + y, m, day) or is_date(2000 + y, m, day)) and k1 % 11 == x[9] and k2 % 11 == x[10]


def finnish_id(d: str, check: str) -> bool:
    """Six digits of a date, three of a number and a mod-31 character."""
    ok = any(is_date(c + int(d[4:6]), int(d[2:4]), int(d[:2])) for c in (1800, 1900, 2000))
    return ok and "0123456789ABCDEFHJKLMNPRSTUVWXY"[int(d) % 31] == check.upper()


def _any(ws: list[str]) -> str:
    return "|".join(re.escape(w) for w in sorted(set(ws), key=len, reverse=True))


_AT = rf"(?:{GAP}?[@＠]{GAP}?|{GAP}?[\[(<{{]{GAP}?(?:at|snabel-?a|ät|@|a){GAP}?[\])>}}]{GAP}?|{GAP}+(?:at|snabel-?a|snabela){GAP}+)"
_PT = rf"(?:\.|{GAP}?[\[(<{{]{GAP}?(?:dot|punkt|piste|\.|prick|point|pkt){GAP}?[\])>}}]{GAP}?|{GAP}+(?:dot|punkt|prick|piste|point){GAP}+)"
_L = r"[^\W_]"
_EMAIL = re.compile(rf"(?<![\w@＠.+-])(?P<local>[\w](?:[\w.+%\xad​-]*[\w\xad​])?){_AT}(?P<host>{_L}(?:[\w\xad​-]*{_L})?(?:{_PT}{_L}(?:[\w\xad-]*{_L})?)*{_PT}(?P<tld>[a-zA-Z]{{2,}}))(?!\w)", re.I)
_D = r"[\s\xa0 ​./–‑-]"
_PHONE = re.compile(rf"(?<![\w@+#.,/-])(?:(?:\+|00)\d{{1,3}}(?:{_D}?\(0\))?|\(0\d{{1,4}}\)|0\d{{1,4}})(?:{_D}{{0,3}}\d+)*(?![\w@]|[.,:]\d)")
_SE = re.compile(r"(?<![\w+.,/–-])(?P<a>(?:(?:19|20)[ \xa0]?)?\d{2}(?:[ \xa0]?\d{2}){2})[ \xa0]?[-+–‐‑]?[ \xa0]?(?P<b>\d{4})(?![\w]|[-.,/]\d)")
_FI = re.compile(r"(?<![\w-])(?P<a>\d{6})[-+ABCDEFYXWVUabcdefyxwvu](?P<b>\d{3})(?P<c>[0-9A-Ya-y])(?!\w)")
_NO = re.compile(r"(?<![\w+.,/-])(?P<a>\d{6})[ \xa0.-]?(?P<b>\d{5}|\d{3} \d{2})(?![\w]|[-.,/]\d)")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")
_WORDS_BEFORE = re.compile(r"[\w:./-]+")
_NUMBER = re.compile(r"\.?[ \xa0]+(?:nr[ \xa0])?(\d{1,4}(?:[ \xa0]?[a-zA-Z](?!\w))?)(?![\w%]|[.,:]\d)")
_BEFORE_NUMBER = re.compile(r"(?<=[^\W\d_])\.?[ \xa0]+(?:nr[ \xa0])?\d")
_LAST_WORDS = re.compile(r"(?<![\w-])(?:(?P<b>[^\W\d_][\w-]*)(?P<gap>[ \xa0]))?(?P<a>[^\W\d_][\w-]*)$")
_ENDS = tuple(STREET_ENDS)
_ENGLISH = re.compile(r"(?<![\w-])(?P<n>\d{1,4}[a-z]?)[ \xa0](?P<s>(?:[A-Z][a-z]+[ \xa0]){1,2}(?:Street|St|Road|Rd|Lane|Ln|Yard|Row|Close|Avenue|Ave|Drive|Way|Court|Square|Terrace|Hill|Mews|Green|Walk|Place|Crescent))\b")
_FRENCH = re.compile(r"(?<![\w-])(?P<n>\d{1,4}(?: bis| ter)?),?[ \xa0](?P<s>(?:rue|avenue|boulevard|place|chemin|impasse|quai|allée|ruelle)(?:[ \xa0](?:de|du|des|la|le|les|d'|l'))*[ \xa0'’]?[^\W\d_][\w'’-]+)", re.I)
_POSTAL = re.compile(r"(?:,|\s)?\s*(?:(?:lgh|läg|vån|port)\.?[ \xa0]\d+|\d+[ \xa0]tr\.?)?,?\s*(?:(?:S|SE|N|D|F|FI|FIN|DE|FR)-)?\d{3}[ \xa0]?\d{2}[ \xa0]+[^\W\d_][\w-]+")


_PLURAL = re.compile(r"\s[a-zåäö]+(?:ar|er|or|n)\b")
_UNIT = re.compile(r"[ \xa0](?:kr|kg|cm|mm|m|km|st|procent|år|dl|kl|minuter|personer)\b")


def _near(text: str, at: int, n: int = 3) -> list[str]:
    """The last ``n`` words before a place."""
    reach = 48
    while True:
        found = list(_WORDS_BEFORE.finditer(text, max(0, at - reach), at))[-n:]
        if reach >= at or (len(found) == n and found[0].start() > at - reach):
            return [m.group().lower().strip(".:/-") for m in found]
        reach *= 2


def _phones(t: str) -> Iterator[tuple[float, int, int, str]]:
    for m in _PHONE.finditer(t):
        s = m.group()
        if "\n" in s or "\r" in s:
            s = re.split(r"[\r\n]", s)[0].rstrip()
        d = re.sub(r"\D", "", s.replace("(0)", ""))
        plus = s[0] == "+" or s.startswith("00")
        if not (8 if plus else 7) <= len(d) - (2 if s.startswith("00") else 0) <= (13 if plus else 11):
            continue
        before = _near(t, m.start())
        score = 1.0 + 0.5 * plus
        if any(w in PHONE_WORDS for w in before):
            score += 1
        if before and any(w in NOT_IDS for w in before[-2:]):
            score -= 2
        plain = re.fullmatch(r"\d+", s)
        if re.match(r"\d{4}-\d\d-\d\d", s) or (re.match(r"0\d\.\d\d(?!\d)", s) and len(d) < 9):
            score -= 2
        if plain and not plus and len(d) not in (9, 10):
            score -= 1
        if plain and len(d) > 11:
            score -= 1
        at = m.start() + (s[0] == "(")
        yield score, at, m.start() + len(s), "phone"


def _ids(t: str) -> Iterator[tuple[float, int, int, str]]:
    for rx, ok in ((_SE, lambda m: swedish_id(re.sub(r"\D", "", m["a"]) + m["b"])), (_FI, lambda m: finnish_id(m["a"] + m["b"], m["c"])), (_NO, lambda m: norwegian_id(re.sub(r"\D", "", m["a"] + m["b"])))):
        for m in rx.finditer(t):
            if not ok(m):
                continue
            before = _near(t, m.start(), 4)
            score = 1.6
            if any(w in ID_WORDS for w in before):
                score += 1
            if any(w in NOT_IDS for w in before[-2:]):
                score -= 2
            if any(w in PHONE_WORDS for w in before[-2:]):
                score -= 0.7
            yield score, m.start(), m.end(), "id_number"


def _addresses(t: str) -> Iterator[tuple[float, int, int, str]]:
    for m in _BEFORE_NUMBER.finditer(t):
        at = m.start()
        w = _LAST_WORDS.search(t, max(0, at - 70), at)
        number = _NUMBER.match(t, at)
        if not w or not number:
            continue
        last, before = w["a"].lower(), (w["b"] or "").lower()
        street = last.endswith(_ENDS) and last not in ROADS and last not in STREET_ENDS
        own_word = bool(w["b"]) and last in STREET_ENDS and last not in ROADS and len(before) > 3 and before[-1] == "s"  # "Anders gata"
        farm = before in FARM and len(last) > 2
        if not (street or farm or own_word):
            continue
        if last.endswith("str") != (t[at] == ".") and last.endswith("str") and not last.endswith("straße"):
            continue
        start = w.start("b") if before in FARM or own_word else w.start("a")
        score = 1.2
        postal = _POSTAL.match(t, number.end())
        if street and w["a"][0].islower() and not postal and t[:start].rstrip(" \xa0")[-1:] not in ("", "\n", "\r", "\u2028", ":"):
            near = _near(t, start, 1)
            score -= 0 if near and near[0] in BEFORE_STREETS else 0.4
        if not street and not own_word:
            if not (w["a"][0].isupper()) and not w["b"][0].islower():
                score -= 0.5
            if not postal and (w["a"][0].islower() or _PLURAL.match(t, number.end())):
                score -= 0.5
        if _UNIT.match(t, number.end()):
            score -= 1
        yield score, start, postal.end() if postal else number.end(), "address"
    for rx in (_ENGLISH, _FRENCH):
        for m in rx.finditer(t):
            yield 1.2, m.start(), m.end(), "address"


def _emails(t: str) -> Iterator[tuple[float, int, int, str]]:
    if not ("@" in t or "＠" in t or re.search(r"(?i)\bat\b|snabel|[\[(]a[\])]", t)):
        return
    for m in _EMAIL.finditer(t):
        spoken = not ("@" in m.group() or "＠" in m.group())
        if spoken and re.search(r"[\s]at[\s]", m.group(), re.I) and "." in m["local"] + "x" and not re.search(r"dot|punkt|[+_.\d]", m.group()[: len(m["local"])] + m.group()):
            continue
        if spoken and not re.search(r"[\[(<{]|snabel|\bdot\b|punkt", m.group(), re.I):
            continue  # "at" between plain words
        yield 3.0, m.start("local"), m.end(), "email"


class Names:
    """The words of names: given names, surnames and the parts of which surnames are made."""

    def __init__(self, given: set[str], surnames: set[str]):
        self.given, self.surnames = given, surnames
        heads, tails = defaultdict(set), defaultdict(set)
        for s in surnames:
            for i in range(2, len(s) - 2):
                heads[s[:i]].add(s[i:])
                tails[s[i:]].add(s[:i])
        self.tails = {x for x, v in tails.items() if len(v) >= 4}
        self.heads = {x for x, v in heads.items() if len(v & self.tails) >= 4}

    @lru_cache(maxsize=100_000)  # noqa: B019
    def is_surname(self, w: str) -> bool:
        w = w.lower()
        if w in self.surnames:
            return True
        if "-" in w:
            a, _, b = w.rpartition("-")
            return self.is_surname(b) and len(a) > 1
        return any(w[:i] in self.heads and w[i:] in self.tails for i in range(2, len(w) - 2))


_NAME_WORD = r"[^\W\d_][^\W\d_\xad]*(?:[-\xad][^\W\d_]+)*"
_SP = r"[ \xa0​ ]+"
_PARTICLE = r"(?:(?:af|av|von|van|der|den|de|la|du|zu|ten)\s)"
_TOKENS = re.compile(rf"(?<![\w@.+-])(?P<w>{_NAME_WORD})(?![\w@＠])")
_AFTER_GIVEN = re.compile(rf"(?P<sp>[ \xa0​ ]{{1,3}})(?P<mid>(?:[A-Za-zÅÄÖåäö]\.{_SP}|[A-ZÅÄÖ]{_SP}(?=[A-ZÅÄÖ]{{2}}))?)(?P<par>(?:(?:af|av|von|van|der|den|de|la|du|zu|ten)[ \xa0])*)(?P<s>{_NAME_WORD})(?![\w@＠]|\.[a-z])", re.I)
_COMMA_GIVEN = re.compile(rf",[ \xa0]+(?P<g>{_NAME_WORD}|[A-ZÅÄÖ]\.)")
_INITIAL = re.compile(rf"(?<![\w@.+-])(?P<i>[A-ZÅÄÖ]\.[ \xa0]?(?:[A-ZÅÄÖ]\.[ \xa0]?)?)(?P<par>(?:(?:af|av|von|van|der|de|la|du|zu)[ \xa0])*)(?P<s>{_NAME_WORD})(?![\w@＠]|\.[a-z])", re.I)
_DOTTED = re.compile(r"(?<!\w)[A-Za-zÅÄÖåäö]\.")
_FIRM = re.compile(r"[ \xa0]*(?:&|AB\b|HB\b|KB\b|i[ \xa0]\w+[ \xa0]AB|och Söner|GmbH|Ltd|Oy\b|stiftelse)")
_OF_FIRM = re.compile(r"(?:&|Bolaget|Firma|AB|Stiftelsen|Restaurang|Hotell|Galleri|Byggnads AB)[ \xa0]$", re.I)


#: Before a surname without a given name; such a use speaks neither for nor against it.
_BY_NAME = re.compile(r"\b(?:hr|herr|fru|fröken|dr|prof|mr|mrs|ms|miss|frau|familjen|[a-zåäö])\b\.?\s+$", re.I)
_NEXT = re.compile(rf"[ \xa0]+(?P<g>{_NAME_WORD})")
_RUNS = re.compile(r"[^\W\d_]+")


def _names(t: str, n: Names) -> Iterator[tuple[float, int, int, str]]:
    low = t.replace("\xad", "").lower()
    if n.given.isdisjoint(_RUNS.findall(low)) and not _DOTTED.search(t):
        return  # neither a given name nor an initial
    for m in _TOKENS.finditer(t):
        w = m["w"].replace("\xad", "")
        if w.lower() in n.given:
            a = _AFTER_GIVEN.match(t, m.end())
            if a:
                s = a["s"].replace("\xad", "")
                known = n.is_surname(s)
                if known and not _FIRM.match(t, a.end()) and not _OF_FIRM.search(t[max(0, m.start() - 16) : m.start()]):
                    yield 1.5 + known, m.start(), a.end(), "name"
        elif n.is_surname(w):
            c = _COMMA_GIVEN.match(t, m.end())
            if c and (c["g"].lower() in n.given or len(c["g"]) == 2 and c["g"][1] == "." and c["g"][0].isupper()):
                start = m.start()
                p = re.search(rf"(?:(?:af|av|von|van|der|de|la|du|zu)[ \xa0])+$", t[max(0, start - 14) : start], re.I)
                yield 2.4, start - (len(p.group()) if p else 0), c.end(), "name"
                continue
            a = _NEXT.match(t, m.end())  # surname first, without a comma
            if a and a["g"].lower() in n.given:
                after = _AFTER_GIVEN.match(t, a.end())
                prior = re.search(rf"({_NAME_WORD})[ \xa0]+$", t[max(0, m.start() - 40) : m.start()])
                if not (after and n.is_surname(after["s"])) and not (prior and prior[1].lower() in n.given):
                    yield 1.4, m.start(), a.end(), "name"
    for m in _INITIAL.finditer(t):
        if n.is_surname(m["s"].replace("\xad", "")):
            prior = re.search(rf"({_NAME_WORD})[ \xa0​]+$", t[max(0, m.start() - 40) : m.start()])
            if not (prior and prior[1].replace("\xad", "").lower() in n.given) and not _FIRM.match(t, m.end()):
                yield 2.2, m.start(), m.end(), "name"


def spans(t: str | None, names: Names) -> list[tuple[int, int, str]]:
    """(start, end, kind) in order, without overlaps."""
    if not t or t.isspace():
        return []
    found = [x for f in (_emails, _phones, _ids, _addresses) for x in f(t)]
    found += _names(t, names)
    if found:  # an account takes away what lies in it
        found += [(9.0, m.start(), m.end(), "") for m in _IBAN.finditer(t) if mod97(m.group())]
    found = sorted((x for x in found if x[0] >= 1), key=lambda x: (-x[0], x[1], x[1] - x[2]))
    taken: list[tuple[int, int, str]] = []
    for _, a, b, kind in found:
        if all(b <= x or a >= y for x, y, _ in taken):
            taken.append((a, b, kind))
    return sorted(x for x in taken if x[2])


def learn_names(docs: DataFrame, given: DataFrame, name_col: str = "name", text_col: str = "text", least: int = 2, max_lexicon: int = 2_000_000) -> Names:
    """The lexicon of a corpus, from listed given names (a bounded table; more than ``max_lexicon`` rows raise an error).

    A word counts as a name if at least a fifth of its uses in the whole corpus, ``least`` or more, are those of one.
    """

    def bounded(df: DataFrame) -> list:
        rows = df.limit(max_lexicon + 1).collect()
        if len(rows) > max_lexicon:
            raise ValueError(f"more than max_lexicon = {max_lexicon} words of names")
        return rows

    listed = {r[0].strip().lower() for r in bounded(given.select(name_col).filter(F.col(name_col).isNotNull()))} - {""}
    src = docs.select(F.col(text_col).alias("t")).filter(F.col("t").isNotNull())

    def count(of) -> dict[str, tuple[int, int]]:
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hits, others = Counter(), Counter()

            def counted() -> pa.RecordBatch:
                ws = list(hits | others)  # a word without a hit here may have some in other tasks
                out = [pa.array(ws, pa.string()), pa.array([hits[w] for w in ws], pa.int64()), pa.array([others[w] for w in ws], pa.int64())]
                hits.clear()
                others.clear()
                return pa.RecordBatch.from_arrays(out, names=["w", "h", "o"])

            for b in chunks(it, "t"):
                for t in b.column(0).to_pylist():
                    of(t, hits, others)
                if len(hits) + len(others) > 200_000:
                    yield counted()
            yield counted()

        got = src.mapInArrow(run, "w string, h long, o long").groupBy("w").agg(F.sum("h").alias("h"), F.sum("o").alias("o"))
        return {w: (h, o) for w, h, o in bounded(got.filter((F.col("h") >= least) & (F.col("h") * 4 >= F.col("o"))))}

    def surnames(t: str, hits: Counter, others: Counter) -> None:
        at = -1
        for m in _TOKENS.finditer(t):
            w = m["w"].lower()
            if not m["w"][0].isupper():
                continue
            if w in listed:
                a = _AFTER_GIVEN.match(t, m.end())
                if a and a["s"][0].isupper() and len(a["s"]) > 1 and a["s"].lower() not in listed:
                    hits[a["s"].lower()] += 1
                    at = a.start("s")
            elif len(w) > 1 and m.start() != at and not _BY_NAME.search(t, max(0, m.start() - 20), m.start()):
                others[w] += 1

    found = {s.rpartition("-")[2] for s in count(surnames)}
    rough = Names(listed, found)

    def givens(t: str, hits: Counter, others: Counter) -> None:
        for m in _TOKENS.finditer(t):
            w = m["w"]
            if w[0].isupper() and w.lower() not in listed and len(w) > 1:
                a = _AFTER_GIVEN.match(t, m.end())
                if a and rough.is_surname(a["s"]) and a["s"][0].isupper() and not _COMMA_GIVEN.match(t, a.end()):
                    hits[w.lower()] += 1
                else:
                    others[w.lower()] += 1

    more = {w for w in count(givens) if w not in TITLES and not rough.is_surname(w)}
    return Names(listed | more, found)


def find_personal(df: DataFrame, names: Names, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start_pos, end_pos, kind) of each span."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t"):
            got = [(i, *s) for i, t in enumerate(b.column(1).to_pylist()) for s in spans(t, names)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array([g[0] for g in got], pa.int64())), pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.int32()), pa.array([g[3] for g in got], pa.string())],
                names=[id_col, "start_pos", "end_pos", "kind"],
            )

    src = spread(df.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t"))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, start_pos int, end_pos int, kind string")


def masked(df: DataFrame, names: Names, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text with placeholders such as [EMAIL], spans replaced); every row comes out, null texts as null."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t"):
            out, n = [], []
            for t in b.column(1).to_pylist():
                at, parts, found = 0, [], spans(t, names)
                for a, z, kind in found:
                    parts += [t[at:a], f"[{kind.upper()}]"]
                    at = z
                out.append(None if t is None else "".join(parts) + t[at:])
                n.append(len(found))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(n, pa.int32())], names=[id_col, "masked", "spans"])

    src = spread(df.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t"))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, masked string, spans int")
