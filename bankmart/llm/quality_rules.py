"""Quality rules as a bitmask ledger.

``ledger`` reads every text once: it measures the text and evaluates every rule
of ``RULES`` once, and keeps one row per document with the measurements and the
failed rules as bits of ``failed``.  What is kept is decided afterwards, from the
ledger alone: a ``Policy`` is a named version made of two masks (rules that drop a
document at once, and rules of which only so many may fail), applied with
``apply_policy`` by bitwise operations.  ``ablation`` sums the ledger up to one
row per distinct bitmask (at most 2 ** len(RULES)) and answers from those rows,
for every rule of a policy, how many documents fail it, how many are dropped, and
how many more would stay without it.

Measurements (words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, lines are split
at line feeds and count if they hold a word): n_words; word_chars, code points in
words; n_symbols, characters of ``[#*$%&|<>]``; n_lines; n_dup_lines, lines equal to
an earlier one; n_repeat_words, words inside 8-word windows that the text holds twice
or more, the first included; n_letter_words, words with A-Z, a-z or a code point
beyond ASCII; n_bullet_lines, lines whose first word begins with ``-``, ``*`` or a
bullet; n_ellipsis_lines, lines that end in ``...`` or an ellipsis character.

Repeated windows are found by 64-bit hashes and those with equal hashes are
compared word by word, so the counts are exact.  Work is bounded by a slice of
``SLICE_BYTES`` of texts, or one longer text.

Defined cases: a null, empty or blank text has no words and fails ``few_words``;
repeated rows and null doc_ids are rows of their own; an empty table gives an empty
result; a rule that divides by a count of zero does not fail; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import _IS_SPACE, documents, hashed_words, mix64, staged, utf8_column

WINDOW = 8
SLICE_BYTES = 2 << 20
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letter_words", "n_bullet_lines", "n_ellipsis_lines")

#: rule name -> condition over the measurements, as SQL; a rule's bit is its place
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
    "few_letter_words": "100 * n_letter_words < 80 * n_words",
    "bullet_lines": "100 * n_bullet_lines > 90 * n_lines",
    "ellipsis_lines": "100 * n_ellipsis_lines > 30 * n_lines",
}


def mask(*rules: str) -> int:
    """The bits of ``rules``."""
    names = list(RULES)
    return reduce(lambda a, r: a | 1 << names.index(r), rules, 0)


@dataclass(frozen=True)
class Policy:
    """A document is dropped if it fails a rule of ``hard``, or more than
    ``soft_allowed`` rules of ``soft``."""
    version: str
    hard: int
    soft: int = 0
    soft_allowed: int = 0

    def drops(self, failed: Column) -> Column:
        return (failed.bitwiseAND(F.lit(self.hard)) != 0) | (
            F.bit_count(failed.bitwiseAND(F.lit(self.soft))) > self.soft_allowed)

    def without(self, bit: int) -> "Policy":
        return Policy(self.version, self.hard & ~bit, self.soft & ~bit, self.soft_allowed)


BASE = mask("few_words", "repeated_words")
POLICIES = {p.version: p for p in (
    Policy("v1", BASE),
    Policy("v2", BASE | mask("symbols", "few_letter_words"),
           mask("duplicate_lines", "short_words", "long_words", "bullet_lines", "ellipsis_lines"), 1),
)}
PRODUCTION = "v2"

_STARTS = np.zeros(256, bool)                      # first bytes of code points
_STARTS[[b for b in range(256) if b & 0xC0 != 0x80]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_BULLETS = (b"-", b"*", "•".encode())
_ELLIPSES = (b"...", "…".encode())


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _covered(candidates: np.ndarray, words: list[bytes]) -> int:
    """Words inside the windows at ``candidates`` that really occur twice."""
    at = [tuple(words[p:p + WINDOW]) for p in candidates.tolist()]
    often = Counter(at)
    hit = np.zeros(len(words) + 1, np.int64)
    for p, w in zip(candidates.tolist(), at):
        if often[w] > 1:
            hit[p] += 1
            hit[p + WINDOW] -= 1
    return int((np.cumsum(hit) > 0).sum())


def _repeat_words(body: np.ndarray, offsets: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, np.int64)
    full = len(words) - WINDOW + 1
    if full < 2:
        return out
    roll = words[:full].copy()
    for j in range(1, WINDOW):
        roll = mix64(roll + np.uint64(j)) + words[j:full + j]
    text = np.repeat(np.arange(len(out)), np.diff(first))      # of each word
    inside = text[:full] == text[WINDOW - 1:]
    place = np.flatnonzero(inside)
    key = mix64(roll[place] + mix64(text[place].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(place), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    place = place[twice]
    for t in np.unique(text[place]).tolist():
        mine = place[text[place] == t] - first[t]
        out[t] = _covered(mine, body[offsets[t]:offsets[t + 1]].tobytes().split())
    return out


def _lines(text: bytes) -> tuple[int, int, int, int]:
    lines = [x for x in text.split(b"\n") if not x.isspace() and x]
    bare = [x.strip() for x in lines]
    return (len(lines), len(lines) - len(set(lines)), sum(x.startswith(_BULLETS) for x in bare),
            sum(x.endswith(_ELLIPSES) for x in bare))


def measure(body: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All measurements of the texts ``body[offsets[i]:offsets[i+1]]``."""
    words, first = hashed_words(body, offsets, lower=False)
    space = _IS_SPACE[body]
    word = ~space
    begin = word.copy()
    begin[1:] &= space[:-1]
    begin[offsets[:-1][offsets[:-1] < len(body)]] |= word[offsets[:-1][offsets[:-1] < len(body)]]
    starts = np.flatnonzero(begin)
    letters = np.concatenate([[0], np.cumsum(_LETTER[body])])
    ends = np.append(starts[1:], len(body))        # spaces hold no letters, so the next start will do
    lettered = np.zeros(len(body), bool)
    lettered[starts] = letters[ends] > letters[starts]
    lines = np.array([_lines(body[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())],
                     np.int64).reshape(-1, 4)
    return {"n_words": np.diff(first), "word_chars": _per_text(word & _STARTS[body], offsets),
            "n_symbols": _per_text(_SYMBOL[body], offsets), "n_lines": lines[:, 0], "n_dup_lines": lines[:, 1],
            "n_repeat_words": _repeat_words(body, offsets, words, first),
            "n_letter_words": _per_text(lettered, offsets),
            "n_bullet_lines": lines[:, 2], "n_ellipsis_lines": lines[:, 3]}


def _slices(offsets: np.ndarray):
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
        yield a, b
        a = b


def measurements(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of every row."""
    def of(batches):
        import pyarrow as pa
        for batch in batches:
            body, offsets = utf8_column(batch.column("text"))
            for a, b in _slices(offsets):
                found = measure(body[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *(pa.array(found[m], pa.int64()) for m in MEASURES)],
                    ["doc_id", *MEASURES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measurements and ``failed``, the rules'
    failure bits.  Written once to the shared folder."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    failed = reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")
    return staged(measurements(docs).withColumn("failed", failed), "quality-ledger")


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` by ``policy``."""
    return rows.withColumn("kept", ~policy.drops(F.col("failed")))


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: version, rule, n_failed (documents that fail it),
    n_dropped (of these, those that the policy drops) and n_only (those that would
    stay without the rule).  Every rule is answered from the counts of distinct bitmasks."""
    masks = rows.groupBy("failed").count()
    used = {name: 1 << i for i, name in enumerate(RULES) if (policy.hard | policy.soft) >> i & 1}
    failed, n = F.col("failed"), F.col("count")
    dropped = policy.drops(failed)

    def counted(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("long")

    sums = [F.struct(F.lit(policy.version).alias("version"), F.lit(name).alias("rule"),
                     counted(failed.bitwiseAND(F.lit(bit)) != 0).alias("n_failed"),
                     counted((failed.bitwiseAND(F.lit(bit)) != 0) & dropped).alias("n_dropped"),
                     counted(dropped & ~policy.without(bit).drops(failed)).alias("n_only"))
            for name, bit in used.items()]
    return masks.agg(F.array(*sums).alias("r")).select(F.inline("r"))


def judge(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    rows = apply_policy(ledger(docs), POLICIES[policy])
    base = F.col("failed").bitwiseAND(F.lit(BASE)) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), (~base & F.col("kept")).alias("kept"), "failed")


def op11(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))


def op11_sql(policy: str = PRODUCTION) -> str:
    p = POLICIES[policy]
    bits = " + ".join(f"case when {rule} then {1 << i} else 0 end" for i, rule in enumerate(RULES.values()))
    return rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as s
  from (select r, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from d)),
twice as (select r, i from windows qualify count(*) over (partition by r, s) > 1),
covered as (
  select r, count(distinct i + j) as n from twice, (select unnest(range({WINDOW})) as j) group by r),
lines as (
  select r, x from (select r, unnest(string_split(text, chr(10))) as x from d)
  where regexp_matches(x, '[^\x20\x09-\x0D]')),
lined as (
  select r, count(*) as n_lines, count(*) - count(distinct x) as n_dup_lines,
    count(*) filter (regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')) as n_bullet_lines,
    count(*) filter (regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')) as n_ellipsis_lines
  from lines group by r),
measured as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(covered.n, 0) as n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) as n_letter_words,
    coalesce(n_bullet_lines, 0) as n_bullet_lines, coalesce(n_ellipsis_lines, 0) as n_ellipsis_lines
  from d left join lined using (r) left join covered using (r)),
marked as (select *, cast({bits} as bigint) as failed from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  failed & {BASE} <> 0 as base_failed,
  failed & {p.hard | BASE} = 0 and bit_count(failed & {p.soft}) <= {p.soft_allowed} as kept
from marked"""
