"""Surrogates for personal data: keyed, consistent, of the same kind and format.

One pattern finds mentions of e-mail addresses, hexadecimal secrets and access keys, account,
card, network, social security and phone numbers, and names that follow a title. Each
mention belongs to an entity (its kind and its text without case and, for numbers,
without separators). The surrogate of an entity is made from a keyed hash of it, so that
all mentions of an entity get the same one without a join, in their own format: letters
stay letters of the same script and case, digits digits, separators stay in place. Card
and account numbers that pass their checksum still do, network addresses stay in range,
and names keep title, gender and script.

The entities of all documents are then checked for collisions: two entities with the
same surrogate, or a surrogate that is itself an entity. Those that collide are hashed
again, until none does; only they need a join. Surrogates grow with the attempts, so that
no number of entities is too large. The domain of an e-mail address and the surname of a
full name are entities by themselves, which are settled before the addresses and full
names are. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.llm.common import stored, without

# What introduces a name, by gender, and given names to choose from.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа")
OTHER_TITLES = ("Dr", "Prof", "Доктор")
GIVEN_NAMES = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Frank", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul"),
    ("latin", "f"): ("Anna", "Clara", "Diana", "Elena", "Emma", "Irene", "Julia", "Laura", "Maria", "Nina", "Sofia", "Vera"),
    ("latin", "n"): ("Alex", "Chris", "Kim", "Robin", "Sam", "Toni"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Иван", "Олег", "Павел"),
    ("cyrillic", "f"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга"),
    ("cyrillic", "n"): ("Саша", "Женя", "Валя"),
}
SYLLABLES = {
    "latin": ("ba", "del", "fin", "gor", "hal", "ka", "lor", "mar", "nel", "or", "pen", "ros", "sel", "tam", "vin", "wer"),
    "cyrillic": ("ба", "вор", "гор", "дам", "зин", "кал", "лор", "мар", "нил", "пет", "рос", "сол", "там", "фед", "хар", "чер"),
}
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "han": "安北成大东方高国海和家金力林明南平青山石水天文西新一中子",
    "hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねの",
    "katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノ",
    "hangul": "가나다라마바사아자차카타파하고노도로모보소오조호",
    "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "devanagari": "अआइईउऊएओकखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह",
}
DIGITS = {
    "arabic": "٠١٢٣٤٥٦٧٨٩",
    "devanagari": "०१२३४५६७८९",
}

_TITLES = MALE_TITLES + FEMALE_TITLES + OTHER_TITLES
_TITLE = "|".join(w for t in _TITLES for w in (t, t.upper()))
# A title begins a mention of its own.
_NAME = rf"(?!(?:{_TITLE})(?![\p{{L}}\p{{M}}'’-]))\p{{Lu}}[\p{{L}}\p{{M}}'’-]++"
_WORDED = r"\p{L}\p{M}\p{N}"
_LAST = r"\p{L}[\p{L}\p{M}]++"
# In this order; a mention is of the first kind that fits. Possessive quantifiers take
# runs of any length without going back; domains that don't end in a name have 127 labels.
KINDS = {
    "email": rf"(?<![{_WORDED}._%+-])[{_WORDED}._%+-]++@[{_WORDED}-]++"
    rf"(?:(?:\.[{_WORDED}-]++(?=\.[{_WORDED}-]))*+\.{_LAST}|(?:\.[{_WORDED}-]++){{0,126}}\.{_LAST})",
    "secret": r"(?<![\p{L}\p{N}])[0-9A-Fa-f]{32,}+(?![\p{L}\p{N}])",
    "access_key": r"(?<![\p{L}\p{N}])(?:sk-|pk-|ghp_|gho_|xoxb-|xoxp-|AKIA)[A-Za-z0-9_-]{16,}+",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})){2,5}|\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}"
    r"|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.? {_NAME}(?: {_NAME})*+",
}
PATTERN = "|".join(f"(?:{pattern})" for pattern in KINDS.values())


def _matches(pattern: str, value: Column) -> Column:
    return value.rlike(f"^(?:{pattern})$")


def kind_of(mention: Column) -> Column:
    """The kind of a mention, told by its own text."""
    told = F.when(mention.contains("@"), F.lit("email"))
    for kind in ("secret", "access_key", "iban", "ip", "ssn", "card"):
        told = told.when(_matches(KINDS[kind], mention), F.lit(kind))
    return told.when(mention.rlike("^[0-9+(]"), F.lit("phone")).when(F.size(F.split(mention, " ")) > 2, F.lit("person")).otherwise(F.lit("name"))


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "")


def _last_name(mention: Column) -> Column:
    return F.regexp_extract(mention, r"(\S+)$", 1)


def _gender(mention: Column) -> Column:
    bare = F.lower(F.regexp_replace(F.regexp_extract(mention, r"^(\S+)", 1), r"\.", ""))
    male, female = ([t.lower() for t in titles] for titles in (MALE_TITLES, FEMALE_TITLES))
    return F.when(bare.isin(*male), F.lit("m")).when(bare.isin(*female), F.lit("f")).otherwise(F.lit("n"))


def canonical(kind: Column, mention: Column) -> Column:
    """What all mentions of an entity have in common; of a full name the title's gender and all words."""
    return (
        F.when(kind.isin("email", "ip"), F.lower(mention))
        .when(kind == "name", F.lower(_last_name(mention)))
        .when(kind == "person", F.concat_ws(" ", _gender(mention), F.lower(F.regexp_extract(mention, r"^\S+ (.*)$", 1))))
        .otherwise(F.lower(_bare(mention)))
    )


def _stream(secret: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(secret), *parts), 512)


def _drawn(stream: Column, at: Column, size: Column | int) -> Column:
    """A number below `size` from the place `at` of a stream of hexadecimal digits."""
    return F.conv(F.substr(stream, (at * 2) % 121 + 1, F.lit(6)), 16, 10).cast("long") % size


def _letters(alphabet: str, stream: Column, at: Column) -> Column:
    return F.substr(F.lit(alphabet), (_drawn(stream, at, len(alphabet)) + 1).cast("int"), F.lit(1))


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _grown(attempt: Column, free: int) -> Column:
    """How much is added to a surrogate: nothing for the first attempts, then ever more."""
    return F.greatest(attempt - free, F.lit(0)) * 2


def _replaced(text: Column, stream: Column, fixed: Column, hexadecimal: Column) -> Column:
    """Characters of the same sort for all but the first `fixed` ones (counted from 1).

    Letters of scripts without an alphabet here become Latin ones, and such digits 0 to 9.
    """

    def of_place(c: Column, before: Column) -> Column:
        at = before + 1
        latin = _letters(ALPHABETS["latin"], stream, at)
        other = F.when(c.rlike(r"\p{N}"), _drawn(stream, at, 10).cast("string"))
        for digits in DIGITS.values():
            other = F.when(c.rlike(f"[{digits}]"), _letters(digits, stream, at)).otherwise(other)
        for script, alphabet in ALPHABETS.items():
            if script != "latin":
                other = F.when(c.rlike(rf"(?=\p{{L}})\p{{Is{script.capitalize()}}}"), _letters(alphabet, stream, at)).otherwise(other)
        return (
            F.when(at <= fixed, c)
            .when(c.rlike("[0-9]"), _drawn(stream, at, 10).cast("string"))
            .when(hexadecimal, _letters("abcdef", stream, at))
            .when(c.rlike(r"\p{IsLatin}"), latin)
            .otherwise(F.coalesce(other, latin))
        )

    return F.when(F.char_length(text) > 0, F.array_join(F.transform(_chars(text), of_place), "")).otherwise(text)


def _added(size: Column, stream: Column, after: Column, letters: Column) -> Column:
    """`size` more letters, or digits, from the places behind `after` of a stream."""

    def of_place(i: Column) -> Column:
        at = after + i
        return F.when(letters, _letters(ALPHABETS["latin"], stream, at)).otherwise(_drawn(stream, at, 10).cast("string"))

    return F.when(size > 0, F.array_join(F.transform(F.sequence(F.lit(1), size), of_place), "")).otherwise(F.lit(""))


def _digits(number: Column) -> Column:
    return F.transform(F.sequence(F.char_length(number), F.lit(1), F.lit(-1)), lambda at: F.substr(number, at, F.lit(1)).cast("int"))


def _luhn(number: Column) -> Column:
    """Checksum of a card number; 0 modulo 10 if it is valid."""
    weighed = F.transform(
        _digits(number), lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)
    )
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + d) % 10


def _with_luhn(old: Column, new: Column) -> Column:
    """Set the last digit so that the new number is valid if the old one is."""
    head = F.substr(new, F.lit(1), F.char_length(new) - 1)
    check = ((F.lit(10) - _luhn(F.concat(head, F.lit("0")))) % 10).cast("string")
    return F.when(_luhn(old) == 0, F.concat(head, check)).otherwise(new)


def _mod97(account: Column) -> Column:
    """An account number modulo 97, its country and check digits moved to the end."""
    turned = F.upper(F.concat(F.substr(account, F.lit(5), F.char_length(account)), F.substr(account, F.lit(1), F.lit(4))))
    chars = F.transform(F.sequence(F.lit(1), F.char_length(turned)), lambda at: F.substr(turned, at, F.lit(1)))

    def step(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(chars, F.lit(0), step)


def _with_mod97(old: Column, new: Column) -> Column:
    country, rest = F.substr(new, F.lit(1), F.lit(2)), F.substr(new, F.lit(5), F.char_length(new))
    check = F.lpad((F.lit(98) - _mod97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0")
    return F.when(_mod97(old) == 1, F.concat(country, check, rest)).otherwise(new)


def _octets(address: Column, stream: Column, attempt: Column) -> Column:
    """Octets of as many digits each; after some attempts any octets, at last any numbers."""

    def octet(old: Column, at: Column) -> Column:
        size = F.when(attempt < 2, F.char_length(old)).otherwise(F.lit(0))
        low = F.when(size == 3, F.lit(100)).when(size == 2, F.lit(10)).otherwise(F.lit(1))
        span = F.when(size == 3, F.lit(155)).when(size == 2, F.lit(90)).when(size == 1, F.lit(9)).when(attempt < 6, F.lit(255)).otherwise(F.lit(999))
        return (low + _drawn(stream, at + 1, span)).cast("string")

    return F.array_join(F.transform(F.split(address, r"\."), octet), ".")


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))


def _surname(entity: Column, stream: Column, attempt: Column) -> Column:
    """Syllables of the entity's script, one more with each attempt."""

    def of(script: str) -> Column:
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        places = F.sequence(F.lit(0), attempt + 3)
        return F.array_join(F.transform(places, lambda i: F.get(syllables, _drawn(stream, i * 4 + 1, len(SYLLABLES[script])).cast("int"))), "")

    return F.when(_script(entity) == "cyrillic", of("cyrillic")).otherwise(of("latin"))


# Kinds whose entities have a part that is an entity by itself, and the kind of that.
PARTS = {"email": "domain", "person": "name"}


def part_of(kind: Column, entity: Column) -> Column:
    """The part (kind, entity) of an entity that is an entity by itself, or null."""

    def of(name: str, mark: str) -> Column:
        return F.struct(F.lit(PARTS[name]).alias("kind"), F.substring_index(entity, mark, -1).alias("entity"))

    return F.when(kind == "email", of("email", "@")).when(kind == "person", of("person", " "))


def _labels(domain: Column) -> Column:
    """A domain without its last part, which stays."""
    return F.regexp_extract(domain, r"^(.*)\.", 1)


def _surrogates(entities: Column, secret: str) -> Column:
    """Surrogates of an array of (kind, entity, attempt, of_part, ...), put behind the other fields.

    `attempt` is that of the entity, `of_part` that of its part. A surrogate has an entity's
    letters and digits in lower case, without separators, but for the @ of an address and
    the dots of a network address; a full name has capitals and blanks. What it has grown by stands at the end (of both sides of
    an @). It is made in steps, each of which has the results of the one before as fields,
    so that nothing is computed twice.
    """

    def split(s: Column) -> Column:
        return F.struct(s.alias("of"), part_of(s["kind"], s["entity"]).alias("part"))

    def read(s: Column) -> Column:
        of = s["of"]
        own = F.when(of["kind"] == "email", F.substring_index(of["entity"], "@", 1)).when(of["kind"] == "domain", _labels(of["entity"]))
        return F.struct(
            of.alias("of"),
            _stream(secret, of["kind"], of["attempt"].cast("string"), of["entity"]).alias("stream"),
            s["part"]["entity"].alias("part"),
            F.when(s["part"].isNotNull(), _stream(secret, s["part"]["kind"], of["of_part"].cast("string"), s["part"]["entity"])).alias("of_part"),
            _bare(F.coalesce(own, of["entity"])).alias("bare"),
            F.when(of["kind"] == "email", _bare(_labels(s["part"]["entity"]))).otherwise(F.lit("")).alias("labels"),
        )

    def replace(s: Column) -> Column:
        of = s["of"]
        prefix = (
            F.when(of["kind"] == "iban", F.lit(2))
            .when(of["kind"] != "access_key", F.lit(0))
            .when(of["entity"].rlike("^(sk|pk)"), F.lit(2))
            .when(of["entity"].startswith("gh"), F.lit(3))
            .otherwise(F.lit(4))
        )
        worded = of["kind"].isin("email", "domain", "access_key")

        def whole(text: Column, stream: Column, attempt: Column, fixed: Column) -> Column:
            new = _replaced(text, stream, fixed, of["kind"] == "secret")
            return F.concat(new, _added(_grown(attempt, 2), stream, F.char_length(text), worded))

        return F.struct(
            of.alias("of"),
            s["stream"].alias("stream"),
            s["part"].alias("part"),
            s["of_part"].alias("of_part"),
            s["bare"].alias("bare"),
            whole(s["bare"], s["stream"], of["attempt"], prefix).alias("plain"),
            whole(s["labels"], s["of_part"], of["of_part"], F.lit(0)).alias("labels"),
        )

    def finish(s: Column) -> Column:
        of, plain = s["of"], s["plain"]
        kind = of["kind"]
        letters = (
            F.when(kind == "email", F.concat_ws("@", plain, s["labels"]))
            .when(kind == "ip", _octets(of["entity"], s["stream"], of["attempt"]))
            .when(kind == "name", _surname(of["entity"], s["stream"], of["attempt"]))
            .when(kind == "person", _full_name(of["entity"], s["stream"], of["attempt"], s["part"], _surname(s["part"], s["of_part"], of["of_part"]), secret))
            .when(kind == "card", _with_luhn(s["bare"], plain))
            .when(kind == "iban", _with_mod97(s["bare"], plain))
            .otherwise(plain)
        )
        return F.struct(of.alias("of"), letters.alias("letters"))

    return F.transform(F.transform(F.transform(F.transform(entities, split), read), replace), finish)


def _cased(like: Column, text: Column) -> Column:
    capital = F.concat(F.upper(F.substr(text, F.lit(1), F.lit(1))), F.substr(text, F.lit(2), F.char_length(text)))
    return F.when((F.char_length(like) > 1) & (like == F.upper(like)), F.upper(text)).otherwise(capital)


def _with_ending(script: Column, gender: Column, surname: Column) -> Column:
    ending = F.when(script == "cyrillic", F.when(gender == "f", F.lit("ова")).otherwise(F.lit("ов"))).otherwise(F.lit(""))
    return F.concat(surname, ending)


def _full_name(entity: Column, stream: Column, attempt: Column, last: Column, surname: Column, secret: str) -> Column:
    """Given names of the title's gender and the surname with its ending.

    A given name is chosen by itself at first, by the whole name in further attempts; from
    the third on, further given names are tied to the last one.
    """
    words = F.split(entity, " ")
    gender, script = F.get(words, F.lit(0)), _script(last)

    def chosen(source: Column, at: Column) -> Column:
        found = None
        for (of_script, of_gender), names in GIVEN_NAMES.items():
            name = F.get(F.array(*[F.lit(n) for n in names]), _drawn(source, at, len(names)).cast("int"))
            fits = (script == of_script) & (gender == of_gender)
            found = F.when(fits, name) if found is None else found.when(fits, name)
        return found

    def given(old: Column, i: Column) -> Column:
        own = chosen(_stream(secret, F.lit("given"), old), F.lit(3))
        return F.when(attempt == 0, own).otherwise(chosen(stream, i * 4 + 1))

    size = F.size(words)
    more = _grown(attempt, 1)
    tied = F.transform(F.sequence(F.lit(1), more), lambda i: chosen(stream, (size + i) * 4 + 1))
    names = F.array_join(F.transform(F.slice(words, 2, size - 2), given), " ")
    names = F.when(more > 0, F.concat_ws("-", names, F.array_join(tied, "-"))).otherwise(names)
    return F.concat_ws(" ", names, _with_ending(script, gender, surname))


def _named(mention: Column, surname: Column) -> Column:
    """Title and surname with its ending."""
    last = _last_name(mention)
    new = _cased(last, _with_ending(_script(last), _gender(mention), surname))
    return F.concat_ws(" ", F.substring_index(mention, " ", 1), new)


def _named_whole(mention: Column, names: Column) -> Column:
    """Title, given names and surname, each with the capitals of the word it stands for."""
    old = F.split(mention, " ")
    new = F.zip_with(F.slice(old, F.lit(2), F.size(old)), F.split(names, " "), _cased)
    return F.concat_ws(" ", F.get(old, F.lit(0)), F.array_join(new, " "))


def _placed(like: Column, letters: Column) -> Column:
    """Letters with the separators and capitals of a text; further ones follow at its end."""
    old, new = _chars(_bare(like)), _chars(letters)
    cased = F.zip_with(old, new, lambda o, n: F.when(o.rlike(r"\p{Lu}"), F.upper(n)).otherwise(n))
    between = F.split(F.regexp_replace(like, r"\p{M}", ""), r"[\p{L}\p{N}]", -1)
    return F.array_join(F.zip_with(between, cased, lambda b, n: F.concat(F.coalesce(b, F.lit("")), F.coalesce(n, F.lit("")))), "")


def _placed_domain(like: Column, labels: Column) -> Column:
    return F.concat(_placed(_labels(like), labels), F.lit("."), F.substring_index(like, ".", -1))


def _placed_email(like: Column, letters: Column) -> Column:
    """Both sides by themselves."""
    local, domain = F.substring_index(like, "@", 1), F.substring_index(like, "@", -1)
    return F.concat(
        _placed(local, F.substring_index(letters, "@", 1)), F.lit("@"), _placed_domain(domain, F.substring_index(letters, "@", -1))
    )


def formatted(kind: Column, mention: Column, letters: Column) -> Column:
    """A surrogate in the format of a mention: its separators, its capitals."""
    # The code of the country stays.
    code = F.regexp_extract(mention, r"^(\+[0-9]{1,3}(?=[ .(-]))?", 1)
    plain = _placed(mention, letters)
    return (
        F.when(kind == "name", _named(mention, letters))
        .when(kind == "person", _named_whole(mention, letters))
        .when(kind == "email", _placed_email(mention, letters))
        .when(kind == "ip", letters)
        .when(kind == "phone", F.concat(code, F.substr(plain, F.char_length(code) + 1, F.char_length(plain))))
        .otherwise(plain)
    )


def mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct entities (kind, entity) of all documents, and parts of them that are ones too."""
    found = docs.select(F.explode(mentions(F.col(text))).alias("mention")).distinct()
    kinds = found.select("mention", kind_of(F.col("mention")).alias("kind"))
    whole = kinds.select("kind", canonical(F.col("kind"), F.col("mention")).alias("entity")).distinct()
    return _with_parts(whole).distinct()


def _with_parts(rows: DataFrame) -> DataFrame:
    """Further rows for the parts of entities; other columns are repeated."""
    others = [c for c in rows.columns if c not in ("kind", "entity")]
    each = F.array_compact(F.array(F.struct("kind", "entity"), part_of(F.col("kind"), F.col("entity"))))
    return rows.select(*others, F.explode(each).alias("one")).select(*others, "one.kind", "one.entity")


def _shown(kind: Column, entity: Column, letters: Column) -> Column:
    """What of a surrogate can be told apart in a text.

    Mail addresses are compared with their separators, since those stay in place; of a
    phone number the country's code, which stays too, is not relied on.
    """
    return (
        F.when(kind == "email", _placed_email(entity, letters))
        .when(kind == "domain", _placed_domain(entity, letters))
        .when(kind == "person", F.lower(letters))
        .when(kind == "phone", F.substr(letters, F.lit(4), F.char_length(letters)))
        .otherwise(letters)
    )


def _shown_entity(kind: Column, entity: Column) -> Column:
    """The same of an entity itself."""
    name = F.regexp_extract(entity, r"^\S+ (.*)$", 1)
    return F.when(kind.isin("email", "domain", "ip"), entity).when(kind == "person", name).otherwise(_shown(kind, entity, _bare(entity)))


def second_attempts(known: DataFrame, secret: str) -> DataFrame:
    """Entities whose first surrogate collides, and the attempt that doesn't.

    Parts are settled first, then the entities they are parts of.
    """
    has_part = F.col("kind").isin(*PARTS)
    parts = stored(_settled(known.where(~has_part).withColumn("of_part", F.lit(0)), secret), "attempts")
    whole = known.where(has_part).withColumn("part", part_of(F.col("kind"), F.col("entity")))
    of_part = parts.select(F.struct("kind", "entity").alias("part"), F.col("attempt").alias("of_part"))
    whole = whole.join(of_part, "part", "left").select("kind", "entity", F.coalesce("of_part", F.lit(0)).alias("of_part"))
    return parts.unionByName(_settled(whole, secret))


def _settled(known: DataFrame, secret: str) -> DataFrame:
    """Attempts other than the first, of entities with the attempt of their part.

    Of entities with one surrogate the least keeps it. Surrogates that are entities are
    nobody's. Rounds go on until no collision is left; each has only the losers of the
    one before, against all surrogates taken so far, and from longer surrogates at last.
    """
    kind, entity, letters = F.col("kind"), F.col("entity"), F.col("letters")
    real = stored(known.select(kind, _shown_entity(kind, entity).alias("shown")).distinct(), "real")

    def tried(rows: DataFrame, attempt: int) -> DataFrame:
        one = F.array(F.struct("kind", "entity", F.lit(attempt).alias("attempt"), "of_part"))
        made = rows.select("kind", "entity", "of_part", F.get(_surrogates(one, secret), F.lit(0))["letters"].alias("letters"))
        return made.select("kind", "entity", "of_part", _shown(kind, entity, letters).alias("shown"))

    def settled(rows: DataFrame, taken: DataFrame) -> tuple[DataFrame, DataFrame]:
        free = rows.join(real, ["kind", "shown"], "left_anti").join(taken, ["kind", "shown"], "left_anti")
        winners = stored(free.groupBy("kind", "shown").agg(F.min("entity").alias("entity")), "winners")
        lost = rows.drop("shown").join(winners.select("kind", "entity"), ["kind", "entity"], "left_anti")
        return winners, stored(lost, "losers")

    taken, losers = settled(stored(tried(known, 0), "tried"), real.limit(0))
    done, attempt = None, 0
    while not losers.isEmpty():
        attempt += 1
        winners, losers = settled(stored(tried(losers, attempt), "tried"), taken)
        taken = taken.unionByName(winners)
        named = winners.select("kind", "entity", F.lit(attempt).alias("attempt"))
        done = named if done is None else done.unionByName(named)
    return done if done is not None else known.select("kind", "entity", F.lit(0).alias("attempt")).limit(0)


MAX_BROADCAST_ROWS = 20_000


def anonymised(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """Replace all mentions in `text`, and add `n_entities`, the number of mentions.

    A null text stays null and an empty one empty; both have no mentions. All other
    columns stay as they are, but one named `n_entities`, which is replaced. Equal
    entities have equal surrogates in all rows, whatever the partitioning.
    """
    content = F.col(f"`{text}`")
    known = stored(entities(docs, text), "entities")
    again = stored(second_attempts(known, secret), "attempts")
    kept = without(docs, ["n_entities", "_mentions", "_pieces", "_attempts", "_row"])
    found = kept.withColumn("_mentions", mentions(content))
    if again.isEmpty():
        found = found.withColumn("_attempts", F.lit(None).cast("map<string,int>"))
    else:
        row = F.md5(content)
        mentioned = docs.select(row.alias("_row"), F.explode(mentions(content)).alias("mention"))
        named = mentioned.withColumn("kind", kind_of(F.col("mention"))).withColumn("entity", canonical(F.col("kind"), F.col("mention")))
        small = F.broadcast(again) if again.count() <= MAX_BROADCAST_ROWS else again
        hit = _with_parts(named.select("_row", "kind", "entity")).join(small, ["kind", "entity"]).select("_row", F.concat_ws("\u0001", "kind", "entity").alias("key"), "attempt").distinct()
        by_row = stored(hit.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("key", "attempt"))).alias("_attempts")), "by_row")
        by_row = F.broadcast(by_row) if by_row.count() <= MAX_BROADCAST_ROWS else by_row
        found = found.withColumn("_row", row).join(by_row, "_row", "left").drop("_row")

    def told(mention: Column) -> Column:
        return F.struct(mention.alias("mention"), kind_of(mention).alias("kind"))

    def identified(s: Column) -> Column:
        return F.struct(s["mention"].alias("mention"), s["kind"].alias("kind"), canonical(s["kind"], s["mention"]).alias("entity"))

    def attempt_of(kind: Column, entity: Column) -> Column:
        return F.coalesce(F.element_at("_attempts", F.concat_ws("\u0001", kind, entity)), F.lit(0))

    def counted(s: Column) -> Column:
        part = part_of(s["kind"], s["entity"])
        return F.struct(
            s["mention"].alias("mention"),
            s["kind"].alias("kind"),
            s["entity"].alias("entity"),
            attempt_of(s["kind"], s["entity"]).alias("attempt"),
            attempt_of(part["kind"], part["entity"]).alias("of_part"),
        )

    of_text = F.transform(F.transform(F.transform(F.col("_mentions"), told), identified), counted)
    new = F.transform(
        _surrogates(of_text, secret), lambda s: formatted(s["of"]["kind"], s["of"]["mention"], s["letters"])
    )
    pieces = F.split(content, PATTERN, -1)
    rebuilt = F.array_join(F.zip_with(pieces, new, lambda piece, put: F.concat(piece, F.coalesce(put, F.lit("")))), "")
    whole = F.when(F.size("_mentions") > 0, rebuilt).otherwise(content)
    columns = [whole.alias(c) if c == text else F.col(f"`{c}`") for c in kept.columns]
    return found.select(*columns, F.greatest(F.size("_mentions"), F.lit(0)).cast("long").alias("n_entities"))
