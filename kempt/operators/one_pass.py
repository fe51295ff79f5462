"""Many literal replacements in one pass over the text.

A chain of k ``REPLACE`` calls reads every value k times.  Here all search
strings become one pattern, a trie of alternatives, and every match is replaced
through a map: the text is read twice, whatever the number of rules.  At each
place the longest search string wins, matches do not overlap, and replaced text
is not read again.

That equals the chain only if the rules do not get into each other's way.
``interference`` proves it from the strings alone, for any input, or names the
first two rules for which it cannot; ``replace_all`` then takes the chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIAL = set("\\.[]{}()<>*+-=!?^$|&#~ \t\n\r\f\v")


def _literal(char: str) -> str:
    return "\\" + char if char in _SPECIAL and not char.isspace() else f"\\x{{{ord(char):x}}}" if char.isspace() else char


def trie_pattern(searches: Sequence[str]) -> str:
    """A pattern of all strings, the longest alternative first at every branch."""
    root: dict = {}
    for s in searches:
        node = root
        for c in s:
            node = node.setdefault(c, {})
        node[""] = {}

    def write(node: dict) -> str:
        branches = [_literal(c) + write(node[c]) for c in sorted(k for k in node if k)]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and "" not in node else "(?:" + "|".join(branches) + ")"
        return body + ("?" if "" in node else "")

    return write(root)


def _overlap(a: str, b: str) -> bool:
    """Whether an end of ``a`` is a beginning of ``b`` (shorter than both or not)."""
    return any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)) + 1))


def interference(pairs: Sequence[tuple[str, str]]) -> tuple[int, int] | None:
    """None if one pass equals the chain on every input, else positions of two rules that stand against it.

    Two rules are independent if neither search string holds or overlaps the
    other, so their matches never compete, and if the replacement of the one
    neither holds, lies in, nor overlaps the search string of the other, so no
    match arises from replaced text or over its edges.  An empty replacement
    joins what stands around it and is never independent of a longer search
    string.  Only rules that come later in the chain see replaced text.
    """
    for i, (a, r) in enumerate(pairs):
        for j, (b, _) in enumerate(pairs):
            if i == j:
                continue
            if a in b or b in a or _overlap(a, b) or _overlap(b, a):
                return i, j
            if i < j and (len(b) > 1 if not r else b in r or r in b or _overlap(r, b) or _overlap(b, r)):
                return i, j
    return None


def replace_chain(value: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """``REPLACE`` after ``REPLACE``, in order."""
    for search, replacement in pairs:
        value = F.replace(value, F.lit(search), F.lit(replacement))
    return value


def replace_once(value: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """All replacements in one pass: longest match at the leftmost place; of equal search strings the first counts."""
    table: dict[str, str] = {}
    for search, replacement in pairs:
        table.setdefault(search, replacement)
    if "" in table:
        raise ValueError("an empty search string")
    if not table:
        return value
    pattern = trie_pattern(list(table))
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.regexp_extract_all(value, F.lit(pattern), F.lit(0))
    between = F.split(value, pattern, -1)
    joined = F.zip_with(between, found, lambda text, match: F.concat(text, F.coalesce(F.element_at(lookup, match), F.lit(""))))
    return F.when(F.size(found) > 0, F.array_join(joined, "")).otherwise(value)


def replace_all(value: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """The result of the chain, in one pass where that is proven to be the same."""
    return replace_once(value, pairs) if interference(pairs) is None else replace_chain(value, pairs)
