"""PII: detected entities get keyed surrogates of the same type and format. Native DataFrame functions only.

One pattern finds all entities of a text; the text is cut at them and put together again with their surrogates. A
surrogate is worked out from a secret key, the entity's kind and its canonical form, so every mention of an entity,
however it is written, gets the same one in the mention's own layout. Persons are replaced word by word: a surname
has one surrogate whether a given name stands before it or not; given names follow the gender of the title, and all
names the script they are written in. A collision check over all distinct entities gives a new attempt to entities
that share a surrogate or whose surrogate is itself an entity of the corpus; attempts of these few are joined back. Where a
format has too few values for a corpus, later attempts are longer than the entity, so the check ends for any input.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirefold.llm.common import carried, checkpointed

#: From this attempt on, surrogates are longer than their entities, by two more characters each time.
LONGER = 4

# What entities look like. Runs are possessive or begin at a boundary, so a long text is read once.
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|г-жа"
MALE = "Mr|Herr|Monsieur|Señor|Sr|Господин|г-н"
NAME = r"\p{Lu}[\p{L}'’-]+"
PERSON = rf"(?<![\p{{L}}\d])(?:{FEMALE}|{MALE})\.? {NAME}(?: {NAME}){{0,2}}"
SECRET = r"(?<!\w)(?i:password|passwd|pwd|secret|token|api[_-]?key)(?: ?[=:] ?)[\"']?[^\s\"',;=:]{6,}+"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}+"
ACCESS_KEY = r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)"
HEX = r"(?<!\w)[0-9a-f]{32,64}(?!\w)"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
ADDRESS = rf"(?<![\w.-]){OCTET}(?:\.{OCTET}){{3}}(?![\w-]|\.\d)"
PHONE = (r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\w)"
         r"|(?<![\w.-])\d{3}([.-])\d{3}\1\d{4}(?![\w-])")
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
CARD = (r"(?<![\w-])(?:\d{13,19}(?!\w|-\d)|(?:\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{6} \d{5}"
        r"|\d{4}-\d{6}-\d{5})(?!\w|[ -]\d))")
ENTITY = "|".join((PERSON, SECRET, EMAIL, ACCESS_KEY, HEX, ADDRESS, PHONE, SOCIAL, IBAN, CARD))
#: Texts without any of these hold no entity.
MAYBE = rf"[0-9@]|(?i:passw|pwd|secret|token|api[_-]?key)|{FEMALE}|{MALE}"
SECRET_HEAD = r"^(?i:password|passwd|pwd|secret|token|api[_-]?key)(?: ?[=:] ?)[\"']?"
PERSON_HEAD = rf"^(?:{FEMALE}|{MALE})\.? "

LATIN, CYRILLIC = ("bdfgklmnprstvz", "aeiou"), ("бвгдклмнпрст", "аеиоу")
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CYRILLIC_LOWER = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
HAN = "的一是不了在人有我他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后小么"
#: Kinds of characters of a secret, and what stands for them; ASCII punctuation stays.
SHAPES = ((r"[0-9]|\p{Nd}", DIGITS), ("[a-z]", LOWER), ("[A-Z]", LOWER.upper()), (r"[\p{IsCyrillic}&&\p{Lu}]", CYRILLIC_LOWER.upper()),
          (r"\p{IsCyrillic}", CYRILLIC_LOWER), (r"\p{IsHan}", HAN), (r"\p{Lu}", LOWER.upper()), (r"[^\x00-\x7F]", LOWER))
ENTITY_STRUCT = "struct<kind:string,canon:string>"


def let(value: Column, body) -> Column:
    """``body`` with the value bound to a name, so that it is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def kind_of(mention: Column) -> Column:
    return (F.when(mention.rlike(SECRET_HEAD), "secret").when(mention.rlike(PERSON_HEAD), "person")
            .when(mention.contains("@"), "email").when(mention.rlike("^AKIA[A-Z0-9]{16}$"), "access_key")
            .when(mention.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$"), "address").when(mention.rlike("^[0-9a-f]{32,}$"), "hex")
            .when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), "social").when(mention.rlike(r"^[+(]|^\d{3}([.-])\d{3}\1\d{4}$"), "phone")
            .when(mention.rlike("^[A-Z]"), "iban").otherwise("card"))


def mentions(text: Column) -> Column:
    """All entities of a text in order; none for null."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(MAYBE), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(none)


def _names(mention: Column) -> Column:
    """Words of a person with their kinds: gender of the title for given names, and the script."""
    female = mention.rlike(rf"^(?:{FEMALE})\.? ")
    words = F.split(F.regexp_replace(mention, PERSON_HEAD, ""), " ")
    return let(words, lambda all_: F.transform(all_, lambda w, i: F.struct(
        F.concat(F.when(i == F.size(all_) - 1, "surname").when(female, "female").otherwise("male"),
                 F.when(w.rlike(r"\p{IsCyrillic}"), "_cyrillic").otherwise("")).alias("kind"), F.lower(w).alias("canon"))))


def entities(mention: Column) -> Column:
    """Entities of one mention, ``kind`` and ``canon``: one, or one per word of a person."""
    def of(kind):
        canon = (F.when(kind == "email", F.lower(mention)).when(kind.isin("phone", "social", "card"), F.regexp_replace(mention, "[^0-9]", ""))
                 .when(kind == "iban", F.regexp_replace(mention, " ", "")).when(kind == "secret", F.regexp_replace(mention, SECRET_HEAD, ""))
                 .otherwise(mention))
        return F.when(kind == "person", _names(mention)).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"))))
    return let(kind_of(mention), of)


def _chars(s: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substring(s, i, F.lit(1)))


def _join(parts: Column) -> Column:
    return F.array_join(parts, "")


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The canonical form of an entity's surrogate."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), canon), 256)
    stream = F.concat(*[F.sha2(F.concat(F.lit(f"{key}|{part}|"), inner), 512) for part in (0, 1)])  # 128 bytes

    def with_stream(s):
        def byte(i):
            return F.conv(F.substring(s, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")

        def pick(letters, i):
            return F.substring(F.lit(letters), byte(i) % len(letters) + 1, F.lit(1))

        def shaped(value):
            """Digits for digits and letters for letters; lower hexadecimal stays that. A secret that is mostly
            punctuation becomes letters and digits, for else most of it would stay."""
            hexadecimal = value.rlike("^[0-9a-f]+$") & value.rlike("[a-f]")
            bare = (kind == "secret") & (F.length(F.regexp_replace(value, r"[\x00-\x7F&&[^0-9A-Za-z]]", "")) * 2 < F.length(value))

            def of(c, i):
                out = F.when(hexadecimal, pick("0123456789abcdef", i)).when(bare, pick(LOWER + DIGITS, i))
                for like, letters in SHAPES:
                    out = out.when(c.rlike(like), pick(letters, i))
                return out.otherwise(c)
            return _join(F.transform(_chars(value), of))

        def longer(letters):
            """What late attempts add."""
            return F.when(extra > 0, _join(F.transform(F.sequence(F.lit(64), extra + 63), lambda i: pick(letters, i)))).otherwise("")

        def syllables(letters, n):
            return _join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(pick(letters[0], i * 2), pick(letters[1], i * 2 + 1))))

        def name(letters, female, male, surname):
            more = F.when(attempt > 1, attempt).otherwise(0)
            return (F.when(kind.startswith("female"), F.concat(syllables(letters, more + 2), F.lit(female)))
                    .when(kind.startswith("male"), F.concat(syllables(letters, more + 2), F.lit(male)))
                    .otherwise(F.concat(syllables(letters, more + 3), F.lit(surname))))

        extra = (attempt - (LONGER - 1)) * 2
        local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
        label = F.translate(F.substring(F.sha2(F.concat(F.lit(f"{key}|domain|"), domain), 256), 1, 10), "0123456789", "ghijklmnop")
        tail = F.when(attempt > 1, F.concat(F.lit("."), F.translate(F.substring(s, 200, 10), "0123456789", "ghijklmnop"))).otherwise("")
        length = F.length(canon) + F.greatest(extra, F.lit(0))
        digits = _join(F.transform(F.sequence(F.lit(1), length), lambda i: pick("0123456789", i)))
        # The last digit makes the sum of all, every second one doubled from the right, a multiple of ten.
        body = F.concat(F.substring(canon, 1, 1), F.substring(digits, F.lit(2), length - 2))
        doubled = F.aggregate(F.transform(_chars(body), lambda c, i: F.when((length - i) % 2 == 0, let(
            c.cast("int") * 2, lambda d: d - F.when(d > 9, 9).otherwise(0))).otherwise(c.cast("int"))), F.lit(0), lambda a, b: a + b)
        country = F.greatest(F.length(canon) - 10, F.lit(0))
        return (F.when(kind == "email", F.concat(shaped(local), tail, F.lit("@"), label, F.lit(".example.com")))
                .when(kind == "phone", F.concat(F.substring(canon, F.lit(1), country), pick("23456789", F.lit(0)),
                                                F.substring(digits, country + 2, length)))
                .when(kind == "card", F.concat(body, ((10 - doubled % 10) % 10).cast("string")))
                .when(kind == "social", F.concat(F.lit("9"), F.substring(digits, F.lit(2), length)))  # never issued
                .when(kind == "address", F.concat_ws(".", *[(240 + byte(F.lit(0)) % 15).cast("string"),  # a reserved block
                                                            *[byte(F.lit(i)).cast("string") for i in (1, 2, 3)],
                                                            F.when(extra > 0, longer(LOWER))]))
                .when(kind == "access_key", F.concat(F.lit("AKIA"), _join(F.transform(
                    F.sequence(F.lit(0), F.lit(15)), lambda i: pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", i)))))
                .when(kind == "iban", F.concat(F.substring(canon, 1, 2), shaped(F.substring(canon, F.lit(3), length)), longer(DIGITS)))
                .when(kind.endswith("_cyrillic"), name(CYRILLIC, "на", "н", "р"))
                .when(kind.rlike("^(female|male|surname)"), name(LATIN, "na", "n", "r"))
                .otherwise(F.concat(shaped(canon), longer(LOWER + DIGITS))))
    return let(stream, with_stream)


def _laid_out(mention: Column, canonical: Column) -> Column:
    """Letters and digits of a surrogate in the places of the mention's own; what is left over follows them."""
    own = F.length(F.regexp_replace(mention, "[^0-9A-Za-z]", ""))
    return F.concat(_join(F.transform(_chars(mention), lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substring(
        canonical, F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), "[^0-9A-Za-z]", "")), F.lit(1))).otherwise(c))),
                    F.substring(canonical, own + 1, F.length(canonical)))


def _replaced(key: str, mention: Column, attempt) -> Column:
    """What stands for a mention. ``attempt`` gives the attempt of an entity's kind and canonical form."""
    def of(found):
        def name(e, word):
            new = F.initcap(surrogate(key, e["kind"], e["canon"], attempt(e["kind"], e["canon"])))
            return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(new)).otherwise(new)

        def single(e):
            new = surrogate(key, e["kind"], e["canon"], attempt(e["kind"], e["canon"]))
            return let(new, lambda n: F.when(e["kind"].isin("phone", "card", "social", "iban"), _laid_out(mention, n))
                       .when(e["kind"] == "secret", F.concat(F.regexp_extract(mention, SECRET_HEAD, 0), n)).otherwise(n))
        title = F.regexp_extract(mention, PERSON_HEAD, 0)
        words = F.split(F.regexp_replace(mention, PERSON_HEAD, ""), " ")
        person = F.concat(title, F.array_join(F.zip_with(found, words, name), " "))
        return F.when(title != "", person).otherwise(single(F.element_at(found, 1)))
    return let(entities(mention), of)


def attempts(found: DataFrame, key: str) -> DataFrame:
    """``kind, canon, attempt`` of the distinct entities whose first surrogate would collide; usually very few.

    Kinds that can look alike are checked together: all names of one script, and all else.
    """
    current = checkpointed(found.select("kind", "canon", F.lit(0).alias("attempt")))
    family = F.when(F.col("kind").rlike("^(female|male|surname)"), F.regexp_replace("kind", "^[a-z]+", "name")).otherwise(F.col("kind"))
    while True:
        made = current.select("kind", "canon", "attempt", family.alias("family"),
                              surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt")).alias("made"))
        owners = made.groupBy("family", "made").agg(F.min(F.struct("attempt", "kind", "canon")).alias("owner"))
        real = made.select("family", F.col("canon").alias("made")).distinct().withColumn("real", F.lit(True))
        judged = made.join(owners, ["family", "made"]).join(real, ["family", "made"], "left")
        again = F.col("real").isNotNull() | (F.col("owner") != F.struct("attempt", "kind", "canon"))
        current = checkpointed(judged.select("kind", "canon", (F.col("attempt") + again.cast("int")).alias("attempt"), again.alias("again")))
        if not current.where("again").limit(1).count():
            return current.where("attempt > 0").select("kind", "canon", "attempt")
        current = current.drop("again")


def distinct_entities(docs: DataFrame) -> DataFrame:
    every = F.flatten(F.transform(mentions(F.col("text")), entities))
    return docs.select(F.inline(every)).distinct()


def surrogated(docs: DataFrame, key: str) -> DataFrame:
    """All rows and columns with surrogates in ``text``, and ``pii_kinds``, the kinds of the mentions in order.

    A null text stays null and has no kinds; a text without entities stays exactly as it is.
    """
    every = carried(docs.drop("pii_kinds"), "text")  # of an earlier run
    changes = attempts(distinct_entities(every.rows), key)
    marked = every.rows.withColumn("found", mentions(F.col("text")))
    if changes.limit(1).count():
        # Attempts reach the documents by way of the mentions: narrow rows, one per document that holds such an entity.
        mark = F.xxhash64("text")
        held = (every.rows.select(mark.alias("mark"), F.inline(F.flatten(F.transform(mentions(F.col("text")), entities)))).distinct()
                .join(changes, ["kind", "canon"]).groupBy("mark")
                .agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("attempts")))
        marked = marked.withColumn("mark", mark).join(held, "mark", "left")

        def attempt(kind, canon):
            mine = F.filter(F.coalesce(F.col("attempts"), F.array().cast("array<struct<kind:string,canon:string,attempt:int>>")),
                            lambda a: (a["kind"] == kind) & (a["canon"] == canon))
            return F.coalesce(F.get(mine, F.lit(0))["attempt"], F.lit(0))
    else:
        def attempt(kind, canon):
            return F.lit(0)
    found, text = F.col("found"), F.col("text")
    gaps = F.split(text, ENTITY, -1)
    new = F.concat(_join(F.zip_with(F.slice(gaps, 1, F.size(found)), F.transform(found, lambda m: _replaced(key, m, attempt)),
                                    lambda g, m: F.concat(g, m))), F.element_at(gaps, -1))
    out = F.when(F.size(found) > 0, new).otherwise(text)
    return every.back(marked, text=out, pii_kinds=F.transform(found, kind_of))


def report(docs: DataFrame, key: str) -> DataFrame:
    """Per document: the text with surrogates, its digest, and how many mentions of which kinds were replaced."""
    out = surrogated(docs.select("doc_id", "text"), key)
    return out.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
                      F.size("pii_kinds").cast("long").alias("n_mentions"),
                      F.array_join(F.array_sort(F.array_distinct("pii_kinds")), ",").alias("kinds"))
