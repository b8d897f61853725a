"""Personal data replaced by keyed surrogates.

Detected entities are e-mail addresses, phone numbers, IPv4 addresses, card and
social security numbers, secrets in assignments, and names after a form of
address. Each has a canonical value, so mentions in different formats are one
entity, in all documents. A keyed hash of that value draws the surrogate:

- numbers keep their length, their country code and whether their check digit
  holds, and every mention keeps its own punctuation;
- addresses and secrets keep the class of every character;
- names keep gender, script, case and the number of words. Given and family names
  are entities of their own, so a person is the same one with or without a title,
  under another title, in full or by the family name alone. Once a document names
  someone after a title, the untitled mentions go as well, and any title that tells
  a gender tells it for all mentions of that person. A redrawn name gets a
  syllable more, so any number of names finds room.

Draws may collide. All distinct entities of the corpus are checked: no two may
share a surrogate, and no surrogate may be an entity that occurs (given names
aside, which tell nobody apart). Who loses draws again until none is left. Only those redrawn travel back to their
documents; all others follow from the key alone, so the texts do not move.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.plans.staging import release, stage

MAX_DRAWS = 64
_TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Госпожа", "Κυρία"),
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "Κύριος"),
    "n": ("Dr", "Prof"),
}
_GENDER = {title: gender for gender, titles in _TITLES.items() for title in titles}
# Given names by script and gender, and syllables of family names.
_GIVEN = {
    "latin": {"f": "Anna Clara Elena Emma Julia Laura Lena Maria Nora Paula Sara Vera".split(), "m": "Adam Bruno David Emil Felix Hugo Jonas Leo Marc Oscar Paul Simon".split()},
    "cyrillic": {"f": "Анна Вера Елена Ирина Мария Нина Ольга София".split(), "m": "Антон Борис Виктор Иван Лев Олег Пётр Юрий".split()},
    "greek": {"f": "Άννα Δάφνη Ελένη Ζωή Ειρήνη Μαρία".split(), "m": "Άρης Γιώργος Ηλίας Κώστας Νίκος Πέτρος".split()},
}
_SYLLABLES = {
    "latin": "ba be da do fa ga ka la le li lo ma me mi na no ra re ri ro sa se ta te ti to va ve vi za".split(),
    "cyrillic": "ба бе ва ве га да до ка ко ла ле ма ми на но ра ре ро са се та те ти то".split(),
    "greek": "βα γα δα κα κο λα λε μα με μι να νο πα ρα ρε σα σε τα τε το".split(),
}
# Last syllables of made-up given names, by gender.
_ENDINGS = {
    "latin": {"f": "na", "m": "ro", "n": "le"},
    "cyrillic": {"f": "на", "m": "ро", "n": "ле"},
    "greek": {"f": "να", "m": "ρο", "n": "λε"},
}
_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_FIND = re.compile(
    r"(?P<secret>(?<![\w])(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?(?P<secret_value>[A-Za-z0-9_\-]{12,}))"
    r"|(?P<email>(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)+)"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))"
    r"|(?P<card>(?<![\w.-])\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{4}(?![\w-]))"
    r"|(?P<ssn>(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w.+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?![\w]))"
    rf"|(?P<name>(?<!\w)(?P<title>{'|'.join(sorted(map(re.escape, _GENDER), key=len, reverse=True))})\.? (?P<who>(?=[^\W\d_a-zа-яα-ω]){_NAME}(?: (?=[^\W\d_a-zа-яα-ω]){_NAME}){{0,2}}))"
)
_WORD = re.compile(rf"(?<!\w){_NAME}(?!\w)")
_LEAST_FAMILY = 3  # letters of a family name that is looked for without a title
_MAYBE = re.compile(rf"[\d@=:]|{'|'.join(map(re.escape, _GENDER))}")


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _luhn(digits: str) -> int:
    """The check sum modulo 10; 0 holds."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def _owner(name: str) -> str:
    """A name without the ending of possession."""
    return name[:-2] if name[-2:] in ("'s", "’s") else name


class _People:
    """Who a document names after titles: given names, family name and gender of each."""

    def __init__(self, titled: list[tuple[str, list[str]]]):
        self.full: dict[tuple[str, ...], set[str]] = {}  # words of a full name, genders of its titles
        single: dict[str, set[str]] = {}
        for gender, words in titled:
            place = self.full if len(words) > 1 else single
            place.setdefault(tuple(words) if len(words) > 1 else words[0], set()).add(gender)
        self.families = {words[-1] for words in self.full}
        self.givens = {w: words for words in self.full for w in words[:-1]}
        # One word is a family name, unless the document has it as a given name only.
        self.alone = {w for w in single if w not in self.givens}
        # A word that only one of the full names has tells that person's gender.
        share = Counter(w for words in self.full for w in set(words))
        for words, genders in self.full.items():
            for word in words:
                if share[word] == 1:
                    genders |= single.get(word, set())
            genders.discard("n")

    def gender(self, words: tuple[str, ...]) -> str:
        known = self.full.get(words, set())
        return next(iter(known)) if len(known) == 1 else "n"

    def parts(self, words: tuple[str, ...], gender: str) -> list[tuple[str, str]]:
        """Kind and canonical value of every word of a name; ``gender`` is that of the title, if one tells it."""
        if len(words) > 1:
            known = self.gender(words)
            own = gender if known == "n" and gender != "n" and not self.full[words] else known
            return [*(("given", f"{own}:{w}") for w in words[:-1]), ("family", words[-1])]
        if words[0] in self.givens and words[0] not in self.families:
            return [("given", f"{self.gender(self.givens[words[0]])}:{words[0]}")]
        return [("family", words[0])]

    def untitled(self, text: str) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """Begin, end and words of full and family names that stand anywhere, the longest first."""
        found = [(m.start(), m.start() + len(_owner(m[0])), _owner(m[0]).casefold(), m[0][0].isupper()) for m in _WORD.finditer(text)]
        most, i = max((len(words) for words in self.full), default=1), 0
        whole = {w for w in (*self.families, *self.alone) if len(w) >= _LEAST_FAMILY}
        while i < len(found):
            for n in range(min(most, len(found) - i), 0, -1):
                run = found[i : i + n]
                words = tuple(w for _, _, w, _ in run)
                together = all(up for *_, up in run) and all(text[a[1] : b[0]] == " " for a, b in zip(run, run[1:]))
                if together and (words in self.full if n > 1 else words[0] in whole):
                    yield run[0][0], run[-1][1], words
                    i += n - 1
                    break
            i += 1


def mentions(text: str | None) -> Iterator[tuple[int, int, str, str]]:
    """``start, end, kind, canonical value`` of every entity in a text, in order; each word of a name is one."""
    if not text or not _MAYBE.search(text):
        return
    found: list[tuple[int, int, str, object]] = []
    for match in _FIND.finditer(text):
        kind = match.lastgroup
        kind = {"secret_value": "secret", "gap": "card", "who": "name", "title": "name"}.get(kind, kind)
        if kind == "secret":
            found.append((*match.span("secret_value"), kind, match["secret_value"]))
        elif kind == "name":
            who = _owner(match["who"])
            found.append((match.start("who"), match.start("who") + len(who), kind, (_GENDER[match["title"]], who.casefold().split(" "))))
        elif kind == "email":
            value = match["email"].rstrip(".-")
            found.append((match.start(), match.start() + len(value), kind, value.casefold()))
        elif kind == "ip":
            if all(int(p) < 256 for p in match["ip"].split(".")):
                found.append((*match.span(), kind, ".".join(str(int(p)) for p in match["ip"].split("."))))
        elif kind == "phone":
            if 7 <= len(_digits(match["phone"])) <= 15:
                code = re.match(r"\+(\d{1,3})(?=\D)", match["phone"])
                found.append((*match.span(), kind, f"{code[1] if code else ''}:{_digits(match['phone'])[len(code[1]) if code else 0:]}"))
        else:
            found.append((*match.span(), kind, _digits(match[kind])))

    named = [value for *_, kind, value in found if kind == "name"]
    if named:
        people = _People(named)
        taken = [(a, b) for a, b, *_ in found]
        starts = [a for a, _ in taken]
        for a, b, words in people.untitled(text):
            at = bisect_left(starts, b)
            if at == 0 or taken[at - 1][1] <= a:
                found.append((a, b, "name", ("n", list(words))))
        found.sort(key=lambda f: f[0])
    for start, end, kind, value in found:
        if kind != "name":
            yield start, end, kind, value
            continue
        gender, words = value
        for part in zip(_spans(text, start, end), people.parts(tuple(words), gender)):
            yield *part[0], *part[1]


def _spans(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Begin and end of the words between two places, single spaces apart."""
    for word in text[start:end].split(" "):
        yield start, start + len(word)
        start += len(word) + 1


def _draws(key: bytes, kind: str, value: str, draw: int) -> Callable[[int], int]:
    """Numbers below a bound, one after the other, from the keyed hash of an entity."""
    seed = hmac.new(key, f"{kind}\0{value}\0{draw}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
    state = {"pool": 0, "size": 1, "block": 0}

    def below(n: int) -> int:
        while state["size"] < n << 64:
            more = hashlib.sha256(seed + state["block"].to_bytes(4, "big")).digest()
            state["pool"], state["size"], state["block"] = (state["pool"] << 256) | int.from_bytes(more, "big"), state["size"] << 256, state["block"] + 1
        state["pool"], out = divmod(state["pool"], n)
        state["size"] //= n
        return out

    return below


def _script(text: str) -> str:
    if any("Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿" for c in text):
        return "greek"
    return "cyrillic" if any("Ѐ" <= c <= "ԯ" for c in text) else "latin"


def _same_class(c: str, below: Callable[[int], int], hexadecimal: bool = False) -> str:
    if c.isdigit():
        return str(below(10))
    if not c.isalpha():
        return c
    script = _script(c)
    alphabet = "abcdef" if hexadecimal else {"greek": "αβγδεζηθικλμνξοπρστυφχψω", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "latin": "abcdefghijklmnopqrstuvwxyz"}[script]
    out = alphabet[below(len(alphabet))]
    return out.upper() if c.isupper() else out


def surrogate(key: bytes, kind: str, value: str, draw: int = 0) -> str:
    """The canonical value that stands for an entity at its ``draw``-th draw."""
    below = _draws(key, kind, value, draw)
    if kind == "family":
        syllables = _SYLLABLES[_script(value)]
        return "".join(syllables[below(len(syllables))] for _ in range(max(3, min(6, len(value) // 2)) + draw))
    if kind == "given":
        gender, _, name = value.partition(":")
        script = _script(name)
        pool = [n for g in ("f", "m") if gender in (g, "n") for n in _GIVEN[script][g]]
        if draw == 0:
            return f"{gender}:{pool[below(len(pool))].casefold()}"
        syllables = _SYLLABLES[script]
        return f"{gender}:" + "".join(syllables[below(len(syllables))] for _ in range(draw)) + _ENDINGS[script][gender]
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        kept = labels[-2:] if labels[-2] == "example" else ["example", labels[-1]]
        masked = ["".join(_same_class(c, below) for c in label) for label in labels[:-2]]
        # Short local parts have few values; two more letters keep draws apart.
        masked_local = "".join(_same_class(c, below) for c in local + "x" * max(0, 8 - len(local)))
        return f"{masked_local}@{'.'.join([*masked, *kept])}"
    if kind == "ip":
        first = value.split(".")[0]
        return ".".join([first if first in ("10", "127", "192") else str(11 + below(111)), *(str(below(256)) for _ in range(3))])
    if kind == "phone":
        code, _, rest = value.partition(":")
        return f"{code}:" + "".join(str(2 + below(8)) if i == 0 else str(below(10)) for i in range(len(rest)))
    if kind == "secret":
        hexadecimal = bool(re.fullmatch(r"[0-9a-fA-F]+", value))
        return "".join(_same_class(c, below, hexadecimal) for c in value)
    digits = "".join(str(1 + below(9)) if i == 0 else str(below(10)) for i in range(len(value)))
    if kind == "card":
        body = digits[:-1]
        right = str((10 - _luhn(body + "0")) % 10)
        return body + (right if _luhn(value) == 0 else str((int(right) + 1 + below(9)) % 10))
    return digits


def _rendered(mention: str, kind: str, value: str) -> str:
    """A surrogate's canonical value in the format of a mention."""
    if kind in ("given", "family"):
        name = value.partition(":")[2] if kind == "given" else value
        return name.upper() if mention.isupper() and len(mention) > 1 else name.title()
    if kind == "email":
        return value.upper() if mention.isupper() else value
    if kind in ("phone", "card", "ssn"):
        left = iter(value.replace(":", ""))
        return "".join(next(left) if c.isdigit() else c for c in mention)
    return value


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {(d, t, kind, value) for d, t, text in zip(*(batch.column(i).to_pylist() for i in range(3))) for _, _, kind, value in mentions(text)}
        columns = list(zip(*sorted(rows))) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["did", "txt", "kind", "value"])


def _drawn(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(key, k, v, d) for k, v, d in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "value", "draw", "made"])

    return run


def _shown(value: str) -> str:
    """SQL: what a text shows of a canonical value: a given name without its gender, a phone's bare digits."""
    return f"CASE kind WHEN 'given' THEN substr({value}, locate(':', {value}) + 1) WHEN 'phone' THEN replace({value}, ':', '') ELSE {value} END"


def settled_draws(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, draw, made`` for distinct entities: no two of a kind look alike, none but given names like one that occurs itself."""
    shape = "kind string, value string, draw int, made string"
    now = stage(entities.selectExpr("kind", "value", "0 AS draw").mapInArrow(_drawn(key), shape), "draws")
    for draw in range(1, MAX_DRAWS):
        real = entities.where("kind <> 'given'").selectExpr("kind", f"{_shown('value')} AS shown").distinct().withColumn("real", F.lit(True))
        seen = now.selectExpr("*", f"{_shown('made')} AS shown")
        winner = seen.groupBy("kind", "shown").agg(F.min(F.struct("draw", "value")).alias("first"))
        judged = seen.join(winner, ["kind", "shown"]).join(real, ["kind", "shown"], "left").select("kind", "value", "draw", "made", (F.col("real").isNotNull() | (F.struct("draw", "value") != F.col("first"))).alias("lost"))
        judged = stage(judged, "judged")
        if judged.where("lost").isEmpty():
            release(judged)
            return now
        release(now)
        again = judged.where("lost").selectExpr("kind", "value", f"{draw} AS draw").mapInArrow(_drawn(key), shape)
        now = stage(judged.where("NOT lost").drop("lost").union(again), "draws")
        release(judged)
    raise RuntimeError(f"surrogates still collide after {MAX_DRAWS} draws; a kind has more entities than values")


def _replaced(key: bytes, columns: int, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, counts = [], []
            for text, redrawn in zip(batch.column(place).to_pylist(), batch.column(columns).to_pylist()):
                draws = {(r["kind"], r["value"]): r["draw"] for r in redrawn or ()}
                parts, last, n = [], 0, 0
                for start, end, kind, value in mentions(text):
                    made = surrogate(key, kind, value, draws.get((kind, value), 0))
                    parts += [text[last:start], _rendered(text[start:end], kind, made)]
                    last, n = end, n + (kind != "given")  # a name counts once
                out.append(text if not n else "".join([*parts, text[last:]]))
                counts.append(n)
            kept = [batch.column(i) for i in range(columns)]
            kept[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], names=[f"c{i}" for i in range(columns + 1)])

    return run


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs (doc_id, text, ...)`` with every entity replaced; ``n_entities`` mentions were.

    The same key gives the same surrogates over the same table. A null text
    stays null; a text without entities stays as it is to the byte. Equal rows
    get equal texts. All columns stay; an n_entities that the input has is
    replaced; an empty table gives no rows.
    """
    base = docs.drop("n_entities")
    names = base.columns
    identity = ["coalesce(CAST(doc_id AS bigint), -9223372036854775808) AS __did", "xxhash64(CAST(text AS string)) AS __txt"]
    found = stage(base.selectExpr(*identity, "CAST(text AS string) AS text").mapInArrow(_entities, "did long, txt long, kind string, value string"), "mentions")
    entities = stage(found.select("kind", "value").distinct(), "entities")
    redrawn = stage(settled_draws(entities, key).where("draw > 0").select("kind", "value", "draw"), "redrawn")
    marked = base.selectExpr("*", *identity)
    shape = "array<struct<kind:string,value:string,draw:int>>"
    if redrawn.isEmpty():
        marked = marked.withColumn("__redrawn", F.lit(None).cast(shape))
    else:
        per_document = found.join(redrawn, ["kind", "value"]).groupBy("did", "txt").agg(F.collect_set(F.struct("kind", "value", "draw")).alias("__redrawn"))  # entities of one document
        marked = marked.join(stage(per_document.toDF("__did", "__txt", "__redrawn"), "redraws"), ["__did", "__txt"], "left")
    fields = [T.StructField(f"c{i}", T.StringType() if f.name == "text" else f.dataType) for i, f in enumerate(base.schema)]
    schema = T.StructType([*fields, T.StructField(f"c{len(names)}", T.LongType())])
    return marked.select(*[f"`{c}`" for c in names], "__redrawn").mapInArrow(_replaced(key, len(names), names.index("text")), schema).toDF(*names, "n_entities")
