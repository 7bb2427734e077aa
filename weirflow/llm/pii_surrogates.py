"""Surrogates for personal data: keyed, of the same kind and form, and never the same for two."""

from __future__ import annotations

import hashlib
import hmac
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weirflow.operators.transforms import quoted

from .common import bit_set, bits_for, flat_map_texts, has_bit, own, stored, unused
from .pii_detect import find_mentions

#: Tries to give an entity a surrogate that nothing else has.
MOST_ATTEMPTS = 64
#: From this try on a surrogate grows, by one more character every so many tries: forms never run out.
SAME_LENGTH = 4
#: The set of texts with mentions: bits per text, and at most so many (16 MB).
BITS_PER_TEXT, MOST_BITS = 32, 1 << 27
#: From one in so many numbers of a form on, surrogates are a permutation of the form.
DENSE = 4
_VOWELS, _CONSONANTS = "aeiou", "bcdfghjklmnpqrstvwxz"


class Draw:
    """A stream of choices told by a key and a label: whoever has the key draws the same."""

    def __init__(self, key: bytes, *label: object):
        self.key, self.label = key, "\0".join(map(str, label)).encode("utf-8", "replace")
        self.block, self.pool, self.size = 0, 0, 1

    def below(self, n: int) -> int:
        if self.size < n << 32:
            more = hmac.digest(self.key, self.block.to_bytes(4, "big") + self.label, hashlib.sha256)
            self.pool, self.size = self.pool << 256 | int.from_bytes(more, "big"), self.size << 256
            self.block += 1
        self.pool, value = divmod(self.pool, n)
        self.size //= n
        return value

    def of(self, choices: str) -> str:
        return choices[self.below(len(choices))]


def _alike(letter: str) -> str:
    """Letters that may stand for a letter: same script, case and sort (vowel or consonant)."""
    low = letter.lower()
    if low in _VOWELS:
        choices = _VOWELS
    elif "a" <= low <= "z":
        choices = _CONSONANTS
    else:
        block, sort = ord(low) & ~31, unicodedata.category(low)
        base = unicodedata.normalize("NFD", low)[0]
        latin = base.isascii()
        vowel = base in _VOWELS
        choices = "".join(
            c
            for c in map(chr, range(block, block + 32))
            if unicodedata.category(c) == sort
            and len(c.upper()) == 1
            and c.upper().lower() == c
            and (not latin or (unicodedata.normalize("NFD", c)[0] in _VOWELS) == vowel)
        )
    return choices or low


def _shaped(text: str, draw: Draw) -> str:
    """Digits for digits, letters for letters of the same script, case and sort; signs stay."""
    out = []
    for c in text:
        if c in "0123456789":
            out.append(draw.of("0123456789"))
        elif c.isalpha():
            new = draw.of(_alike(c))
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def luhn_digit(digits: str) -> str:
    """The digit that, put behind ``digits``, makes a number pass the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (2 if i % 2 == 0 else 1)
        total += value - 9 * (value > 9)
    return str(-total % 10)


def _digits_like(digits: str, draw: Draw, keep: int = 0) -> str:
    """As many digits, the first ``keep`` as they were; no new zero at the start."""
    rest = "".join(draw.of("0123456789") for _ in digits[keep:])
    if keep == 0 and digits[:1] not in ("", "0") and rest[0] == "0":
        rest = draw.of("123456789") + rest[1:]
    return digits[:keep] + rest


def _phone(digits: str, draw: Draw) -> str:
    keep = max(0, len(digits) - 10)  # the country's code
    rest = _digits_like(digits[keep:], draw)
    return digits[:keep] + rest


def _card(digits: str, draw: Draw) -> str:
    new = _digits_like(digits[:-1], draw, 1)
    right = luhn_digit(new)
    if luhn_digit(digits[:-1]) == digits[-1]:
        return new + right
    return new + draw.of("".join(c for c in "0123456789" if c != right))


def _kept_parts(parts: list[str]) -> int:
    """How many parts of an address name a private range."""
    if parts[0] in ("10", "127"):
        return 1
    return 2 if parts[:2] == ["192", "168"] or parts[0] == "172" and 16 <= int(parts[1]) <= 31 else 0


def _ip(address: str, draw: Draw) -> str:
    parts = address.split(".")
    keep = _kept_parts(parts)
    new = [str(1 + draw.below(254)) for _ in parts[keep:]]
    while not keep and new[0] in ("10", "127", "172", "192"):
        new[0] = str(1 + draw.below(223))
    return ".".join(parts[:keep] + new)


def _longer(text: str, more: int, draw: Draw) -> str:
    """As many more letters or digits, each like one of the text's where that leaves a choice."""
    like = [c for c in text if c in "0123456789" or c.isalpha() and len(_alike(c)) > 1] or list("ab")
    return _shaped("".join(like[i % len(like)] for i in range(more)), draw)


def _name(word: str, kind: str, draw: Draw, more: int = 0) -> str:
    """A word of the same script and length; what tells the gender, the end, stays or is made fit."""
    if len(word) == 1:
        return _shaped(word, draw) + _longer(word, more, draw)
    new = _shaped(word[:-1], draw) + _longer(word, more, draw) + word[-1]
    if kind == "given_f" and word[-1] not in "aeiyа" and word.isascii():
        new = new[:-1] + "a"
    if kind == "given_m" and word[-1] in "a" and word.isascii():
        new = new[:-1] + draw.of("nrsl")
    return new


def _secret(value: str, draw: Draw, more: int = 0) -> str:
    for alphabet in ("0123456789abcdef", "0123456789ABCDEF"):
        if set(value) <= set(alphabet):
            return "".join(draw.of(alphabet) for _ in range(len(value) + more))
    return _shaped(value, draw) + _longer(value, more, draw)


def surrogate(key: bytes, kind: str, entity: str, attempt: int, domain: str | None = None) -> str:
    """The ``attempt``-th surrogate of an entity, in the entity's own canonical form.

    Names of all kinds draw alike; the kind only makes the ending fit. ``domain``
    is the surrogate of an email's domain. Names, secrets, domains and the local
    parts of emails grow after a few tries, so that there is always a form that is
    nobody's.
    """
    draw, more = Draw(key, "name" if is_name(kind) else kind, entity, attempt), attempt // SAME_LENGTH
    if kind == "email":
        local, _, own_domain = entity.partition("@")
        return f"{_shaped(local, draw)}{_longer(local, more, draw)}@{domain or surrogate(key, 'domain', own_domain, 0)}"
    if kind == "domain":
        name, _, top = entity.rpartition(".")
        return f"{_shaped(name, draw)}{_longer(name, more, draw)}.{top}"
    if kind == "cloud_key":
        return entity[:4] + "".join(draw.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in entity[4:])
    if kind == "iban":
        return entity[:2] + _shaped(entity[2:], draw)
    if kind == "ssn":
        return _digits_like(entity, draw)
    if kind == "secret":
        return _secret(entity, draw, more)
    by_kind = {"phone": _phone, "card": _card, "ip": _ip}
    return by_kind[kind](entity, draw) if kind in by_kind else _name(entity, kind, draw, more)


def is_name(kind: str) -> bool:
    return kind == "surname" or kind.startswith("given_")


def form(kind: str, entity: str) -> tuple[str, int, int] | None:
    """(name, size, place): the numbers an entity of fixed form is one of, and which; None for other kinds.

    Its surrogates are of the same form. Addresses keep their private range,
    phone numbers the country's code, card numbers the first digit and whether
    they pass the check.
    """
    if kind == "ip":
        parts = entity.split(".")
        keep = _kept_parts(parts)
        place = 0
        for part in parts[keep:]:
            place = place * 256 + int(part)
        return f"ip {'.'.join(parts[:keep])}", 256 ** (4 - keep), place
    if kind == "ssn":
        return "ssn", 10 ** len(entity), int(entity)
    if kind == "phone":
        keep = max(0, len(entity) - 10)
        return f"phone {entity[:keep]} {len(entity)}", 10 ** (len(entity) - keep), int(entity[keep:])
    if kind == "card" and luhn_digit(entity[:-1]) == entity[-1]:
        return f"card {entity[0]} {len(entity)}", 10 ** (len(entity) - 2), int(entity[1:-1])
    return None


def permuted(key: bytes, kind: str, entity: str) -> str:
    """The entity of the same form at another place: a permutation of the form's places, told by the key.

    A Feistel network on numbers of enough bits, gone through until the result is
    a place of the form again; so no two entities have one surrogate, even if all
    that there are stand in one table.
    """
    name, size, place = form(kind, entity)
    half = (max(2, (size - 1).bit_length()) + 1) // 2
    while True:
        left, right = place >> half, place & ((1 << half) - 1)
        for turn in range(6):
            mix = hmac.digest(key, f"{name}\0{turn}\0{right}".encode(), hashlib.sha256)
            left, right = right, left ^ (int.from_bytes(mix[:8], "big") & ((1 << half) - 1))
        place = left << half | right
        if place < size:
            break
    if kind == "ip":
        parts = entity.split(".")
        keep = _kept_parts(parts)
        return ".".join(parts[:keep] + [str(place >> 8 * i & 255) for i in reversed(range(4 - keep))])
    if kind == "ssn":
        return str(place).zfill(len(entity))
    if kind == "phone":
        keep = max(0, len(entity) - 10)
        return entity[:keep] + str(place).zfill(len(entity) - keep)
    new = entity[0] + str(place).zfill(len(entity) - 2)
    return new + luhn_digit(new)


def written_like(mention: str, kind: str, new: str) -> str:
    """A surrogate in the way the mention was written: its signs, blanks and capitals."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(new)
        return "".join(next(digits, "") if c in "0123456789" else c for c in mention)
    if kind == "iban":
        letters = iter(new)
        return "".join(c if c == " " else next(letters, "") for c in mention)
    if kind == "email" or kind == "surname" or kind.startswith("given_"):
        if mention.isupper() and (len(mention) > 1 or kind == "email"):
            return new.upper()
        return "".join(n.upper() if i < len(mention) and mention[i].isupper() else n for i, n in enumerate(new))
    return new


#: Kinds whose surrogates must differ from one another, by what they are taken for. Names are one kind.
_SPACES = {"phone": "digits", "card": "digits", "ssn": "digits", "cloud_key": "secret"}


def assign_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity), no surrogate twice nor an entity itself.

    A name is one entity whatever it was found as, with one surrogate, whose
    ending fits the gender that titles all over the table agree on. Names of all
    kinds share one space in which no surrogate is given twice or is real; so do
    numbers of all kinds, and secrets. An email is put together from a surrogate
    of its local part and that of its domain, which all emails of a domain share.

    Each entity draws; of entities that drew the same one keeps it, and the
    others, like those that drew something that is an entity, draw again. All
    rounds are joins and counts over entities, of which only the few in conflict
    change. Where more than one in DENSE of all numbers of a fixed form are real,
    as in logs of a private network, drawing would not end: there surrogates are a
    keyed permutation of the form, still no two the same, and may be real.
    """
    name = F.lit("name")
    named = F.col("kind").startswith("given_") | (F.col("kind") == "surname")
    group = F.when(named, name).otherwise(F.col("kind"))
    has = [F.bool_or(F.col("kind") == f"given_{g}").alias(g) for g in "fm"]
    ending = F.when(F.col("f") & ~F.col("m"), "given_f").when(F.col("m") & ~F.col("f"), "given_m").otherwise("surname")
    rows = stored(
        entities.groupBy(group.alias("group"), "entity")
        .agg(*has)
        .select("group", "entity", F.when(F.col("group") == name, ending).otherwise(F.col("group")).alias("form")),
        "entities",
    )
    emails, others = rows.where("group = 'email'"), rows.where("group != 'email'")
    domain = F.substring_index("entity", "@", -1)
    domains = emails.select(F.lit("domain").alias("group"), domain.alias("entity"), F.lit("domain").alias("form")).distinct()
    nothing = F.lit(None).cast("string").alias("domain")
    first = stored(_settled(others.unionByName(domains).select("*", nothing), key), "surrogates")
    of_domain = first.where("group = 'domain'").select(F.col("entity").alias("own"), F.col("surrogate").alias("domain"))
    second = _settled(emails.withColumn("own", domain).join(of_domain, "own").select("group", "entity", "form", "domain"), key)
    told = first.where("group != 'domain'").unionByName(second)
    pairs = entities.select("kind", "entity", group.alias("group")).distinct()
    return pairs.join(told, ["group", "entity"]).select("kind", "entity", "surrogate")


def _settled(rows: DataFrame, key: bytes) -> DataFrame:
    """(group, entity, surrogate) for distinct (group, entity, form, domain), as told above."""
    spaces = F.create_map(*[F.lit(x) for pair in _SPACES.items() for x in pair])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [form(*pair) or ("", 0, 0) for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found]), pa.array([float(f[1]) for f in found])], ["of", "size"])

    fixed = rows.where(F.col("group").isin("ip", "ssn", "phone", "card")).select("group", "entity")
    full = fixed.mapInArrow(placed, "of string, size double").where("size > 0").groupBy("of", "size").count()
    # Few forms can be this full: each has as many rows of its own.
    dense = {r["of"] for r in full.where(F.col("count") * DENSE > F.col("size")).collect()}

    def drawn(some: DataFrame) -> DataFrame:
        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new, fixed_now = [], []
                for kind, entity, domain, attempt in zip(
                    *(batch.column(c).to_pylist() for c in ("form", "entity", "domain", "attempt")), strict=True
                ):
                    of = form(kind, entity) if dense else None
                    fixed_now.append(of is not None and of[0] in dense)
                    new.append(permuted(key, kind, entity) if fixed_now[-1] else surrogate(key, kind, entity, attempt, domain))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(new, pa.string()), pa.array(fixed_now, pa.bool_())],
                    [*batch.schema.names, "surrogate", "fixed"],
                )

        given = some.select("group", "entity", "form", "domain", "attempt")
        kinds = "group string, entity string, form string, domain string, attempt int, surrogate string, fixed boolean"
        return given.mapInArrow(draw, kinds).withColumn("space", F.coalesce(spaces[F.col("group")], F.col("group")))

    state = stored(drawn(rows.withColumn("attempt", F.lit(0))), "surrogates")
    for _ in range(MOST_ATTEMPTS):
        owners = state.groupBy("space", "surrogate").agg(F.min(F.struct((~F.col("fixed")).alias("drawn"), "group", "entity")).alias("owner"))
        real = state.select("space", F.col("entity").alias("surrogate")).distinct().withColumn("real", F.lit(True))
        shared = (F.col("group") != F.col("owner.group")) | (F.col("entity") != F.col("owner.entity"))
        judged = stored(
            state.join(owners, ["space", "surrogate"])
            .join(real, ["space", "surrogate"], "left")
            .withColumn("again", ~F.col("fixed") & (shared | F.col("real").isNotNull()))
            .drop("owner", "real"),
            "judged",
        )
        if judged.where("again").isEmpty():
            return state.select("group", "entity", "surrogate")
        kept = judged.where("NOT again").select(*state.columns)
        again = judged.where("again").withColumn("attempt", (F.col("attempt") + 1).cast("int"))
        state = stored(kept.unionByName(drawn(again).select(*state.columns)), "surrogates")
    raise ValueError(f"after {MOST_ATTEMPTS} rounds some entities still share a surrogate: too many for their form")


def replace_pii(docs: DataFrame, key: bytes, text_column: str = "text") -> DataFrame:
    """``docs`` with every mention of personal data replaced, and ``n_replaced`` and ``kinds`` added.

    Emails, phone numbers, payment card numbers, IP addresses, social security
    and bank account numbers, cloud keys, passwords and tokens, and names after
    a title are replaced by surrogates that depend on ``key`` and the entity
    alone: one entity has one surrogate in all texts and ways of writing, and
    over the whole table two entities never share one. A surrogate keeps kind,
    length (names, secrets and emails grow where their forms run out), script, signs and capitals, a card number whether it passes its
    check digit, an address its private range, a name the ending that shows the
    gender.

    Two scans: the first finds mentions, of which only distinct entities are
    gathered; the second passes texts without mentions straight through and
    joins the others, named by content, with the surrogates of their entities.
    An entity with very many mentions is one row per text in that join, which
    Spark splits.

    A null text stays null; without mentions a text stays as it is and has
    ``n_replaced`` 0 and no ``kinds``. Repeated rows and texts are treated alike.
    All columns stay; ``n_replaced`` or ``kinds`` already there are overwritten.
    An empty table gives no rows.
    """
    own_names = [c for c in docs.columns if c.lower() not in ("n_replaced", "kinds")]
    docs = docs.select(*[F.col(quoted(c)) for c in own_names])
    named, made, some, hit = unused(docs, "text_key", "surrogates", "some", "hit")
    text = F.col(quoted(text_column))
    keyed = docs.withColumn(named, F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))))

    def start():
        return lambda texts: [sorted({(m.kind, m.entity) for m in find_mentions(x)}) for x in texts]

    found = keyed.select(F.col(named).alias("key"), text.alias("text"))
    found = stored(flat_map_texts(found, ["key"], F.col("text"), "kind string, entity string", start), "mentions")
    found = stored(found.distinct(), "held")
    surrogates = stored(assign_surrogates(found.select("kind", "entity").distinct(), key), "assigned")
    edits = stored(
        found.join(surrogates, ["kind", "entity"])
        .groupBy(F.col("key").alias(named))
        .agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias(made)),
        "edits",
    )
    bits = bits_for(edits.count(), BITS_PER_TEXT, MOST_BITS)
    marked = keyed.withColumn(some, bit_set(edits.select(F.xxhash64(named).alias("h")), bits)).withColumn(
        hit, has_bit(F.col(some), F.xxhash64(named), bits)
    )
    none = F.array().cast("array<struct<kind:string,entity:string,surrogate:string>>")
    joined = marked.where(hit).join(edits, named, "left").withColumn(made, F.coalesce(made, none)).select(*own(docs), made)
    clean = marked.where(~F.col(hit)).select(*own(docs))
    edited = _rewritten(joined, text_column, made)
    return clean.withColumns({"n_replaced": F.lit(0).cast("long"), "kinds": F.lit("")}).unionByName(edited)


def _rewritten(docs: DataFrame, text_column: str, made: str) -> DataFrame:
    """The texts with their surrogates in; ``made``, the last column, goes."""
    names = docs.columns[:-1]
    at = names.index(text_column)
    # Python gets the columns by number: names with dots cannot be handed over.
    given = docs.toDF(*[f"c{i}" for i in range(len(names))], "made")
    schema = StructType(given.schema.fields[:-1]).add("n_replaced", "long").add("kinds", "string")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                _rewrite(text, {(e["kind"], e["entity"]): e["surrogate"] for e in edits})
                for text, edits in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)
            ]
            texts, numbers, kinds = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            columns += [pa.array(numbers, pa.int64()), pa.array(kinds, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return given.mapInArrow(rewrite, schema).toDF(*names, "n_replaced", "kinds")


def _rewrite(text: str | None, surrogates: dict[tuple[str, str], str]) -> tuple[str | None, int, str]:
    if text is None or not surrogates:
        return text, 0, ""
    data, parts, at, kinds = text.encode(), [], 0, set()
    mentions = find_mentions(data)
    for m in mentions:
        new = written_like(data[m.start : m.stop].decode(), m.kind, surrogates[m.kind, m.entity])
        parts += [data[at : m.start], new.encode()]
        at = m.stop
        kinds.add(m.kind)
    return b"".join([*parts, data[at:]]).decode(), len(mentions), ",".join(sorted(kinds))
