"""Patterns with Python's meaning for the JVM's and DuckDB's regular expressions.

A pattern is written once, Python style and without look-around. translated() spells out the Unicode classes that the
engines' short forms don't cover, so that both give what Python's re would.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's \s, \d and \w match, as the inside of a character class of both engines.
SPACE_CLASS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
DIGIT_CLASS = r"\p{Nd}"
WORD_CLASS = r"\p{L}\p{N}_"
SPACES = f"[{SPACE_CLASS}]+"
_CLASSES = {"s": SPACE_CLASS, "d": DIGIT_CLASS, "w": WORD_CLASS}


def translated(pattern: str) -> str:
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            n = pattern[i + 1]
            if n in _CLASSES:
                out.append(_CLASSES[n] if inside else f"[{_CLASSES[n]}]")
            elif n in "SDW" and not inside:
                out.append(f"[^{_CLASSES[n.lower()]}]")
            else:
                out.append(c + n)
            i += 2
            continue
        if c == "[" and not inside:
            inside = True
        elif c == "]" and inside and pattern[i - 1] not in "[^":
            inside = False
        out.append(c)
        i += 1
    return "".join(out)


def has_word(words: str) -> str:
    """A test, for either engine, for one of the alternatives standing as a word of its own."""
    return rf"(?:^|[^{WORD_CLASS}])(?:{words})(?:$|[^{WORD_CLASS}])"


def java(pattern: str, flags: str = "") -> str:
    """For Spark: case folding is Unicode's, only a line feed ends a line."""
    return f"(?d{flags}{'u' if 'i' in flags else ''}){translated(pattern)}"


def matches(text: Column, pattern: str, flags: str = "") -> Column:
    return text.rlike(java(pattern, flags))


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_matches(expr: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({expr}, {sql_text((f'(?{flags})' if flags else '') + translated(pattern))})"


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Matches nothing, and is looked for a word at a time.
NEVER = "\uffff" * 8 + "(?!)"


@dataclass(frozen=True)
class Rule:
    """pattern is replaced by put (groups as {1}); flags of i, m, s. need: lower-case text that every match holds."""

    pattern: str
    put: str = ""
    flags: str = ""
    need: str = ""

    def column(self, text: Column, only: Column | None = None) -> Column:
        """only: rows for which the rule can match; for others a pattern that is quickly done with stands in."""
        put = self.put.replace("\\", "\\\\").replace("$", "\\$").replace("{1}", "$1").replace("{2}", "$2")
        pattern = F.lit(java(self.pattern, self.flags))
        return F.regexp_replace(text, pattern if only is None else F.when(only, pattern).otherwise(F.lit(NEVER)), F.lit(put))

    def sql(self, expr: str) -> str:
        put = self.put.replace("\\", "\\\\").replace("{1}", r"\1").replace("{2}", r"\2")
        flags = f"(?{self.flags})" if self.flags else ""
        return f"regexp_replace({expr}, {sql_text(flags + translated(self.pattern))}, {sql_text(put)}, 'g')"


@dataclass(frozen=True)
class Chain:
    """Rules in strict order. gate: lower-case texts, and gate_pattern: a pattern, of which every text that a rule can match
    holds one; other texts skip all rules. Plain texts are looked for many times faster than a pattern of alternatives.

    breaker: for rules that all end at the text's end, characters (a class's inside) that no match holds: what stands before
    the last of them is left alone. whole: pattern of texts for which that isn't so; they are worked on as a whole."""

    rules: tuple[Rule, ...]
    gate: tuple[str, ...] = field(default=())
    gate_pattern: str = ""
    breaker: str = ""
    whole: str = ""

    def column(self, text: Column) -> Column:
        def all_rules(t: Column, low: Column | None) -> Column:
            # rules only take away, so what a rule needs is there from the start
            for r in self.rules:
                t = r.column(t, F.contains(low, F.lit(r.need)) if r.need and low is not None else None)
            return t

        def at_end(t: Column, low: Column | None) -> Column:
            if not self.breaker:
                return all_rules(t, low)
            head = F.regexp_extract(t, rf"(?s)\A(.*[{self.breaker}])", 1)
            cut = let(head, lambda h: F.concat(h, all_rules(F.substring(t, F.length(h) + 1, F.length(t)), low)))
            return F.when(t.rlike(self.whole), all_rules(t, low)).otherwise(cut) if self.whole else cut

        if not self.gate:
            return let(text, lambda t: at_end(t, None)) if self.breaker else all_rules(text, None)

        def gated(t: Column) -> Column:
            def some(low: Column) -> Column:
                found = t.rlike(self.gate_pattern) if self.gate_pattern else F.lit(False)
                for g in self.gate:
                    found = found | F.contains(low, F.lit(g))
                return F.when(found, at_end(t, low)).otherwise(t)

            # the long s folds to s as case does
            return let(F.replace(F.lower(t), F.lit("ſ"), F.lit("s")), some)

        return let(text, gated)

    def sql(self, expr: str) -> str:
        for r in self.rules:
            expr = r.sql(expr)
        return expr


#: White space collapsed and cut from the ends, as " ".join(text.split()).
TIDY = Chain((Rule(r"\s+", " "), Rule(r"^\s+|\s+$")))


def tidy_text(text: Column) -> Column:
    """TIDY, by a pattern that leaves single spaces alone."""
    return F.trim(F.regexp_replace(text, F.lit(f"[{SPACE_CLASS}&&[^ ]][{SPACE_CLASS}]*+| [{SPACE_CLASS}]++"), F.lit(" ")))


#: What SPACE_CLASS holds, character by character.
_SPACE_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def stripped(text: Column) -> Column:
    """str.strip(); no pattern, so only the ends are looked at."""
    return F.btrim(text, F.lit(_SPACE_CHARACTERS))


def sql_stripped(expr: str) -> str:
    return Rule(r"^\s+|\s+\z").sql(expr)


#: A run of other than white space, for the JVM: most characters are told by the first range alone.
_HELD = f"[!-~[^{SPACE_CLASS}]]++"


def words(text: Column) -> Column:
    """str.split(): the runs of other than white space."""
    return F.regexp_extract_all(text, F.lit(_HELD), F.lit(0))


def sql_words(expr: str) -> str:
    return f"regexp_extract_all({expr}, {sql_text(f'[^{SPACE_CLASS}]+')})"


def word_total(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_HELD)).cast("long")


def sql_count(expr: str, pattern: str, flags: str = "") -> str:
    return f"len(regexp_extract_all({expr}, {sql_text((f'(?{flags})' if flags else '') + translated(pattern))}))::BIGINT"


def count(text: Column, pattern: str, flags: str = "") -> Column:
    return F.regexp_count(text, F.lit(java(pattern, flags))).cast("long")
