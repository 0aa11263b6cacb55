"""URL filtering with a bit-parallel wildcard automaton.

All glob rules are packed into one row of machine words, one bit per state. A step reads one byte of every
URL of a batch: `state = (state << 1) & enter[byte] | state & stay[byte]`, with a carry between words, so that all
patterns advance together. `*` matches within a host or a path segment (no `/`), `**` matches anything, `?` one byte
other than `/`. A pattern must match the whole canonical URL, which is the host with A-Z lower-cased and the path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstar.llm.common import ascii_lower, table

#: (verdict, host, path): a rule fits its host and all subdomains where the path begins with the rule's.
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Globs that block where no host rule fits.
BLOCK_GLOBS = (
    "*spam**",
    "*casino**",
    "*porn**",
    "*cheap-pills**",
    "**/wp-login**",
    "**/cgi-bin/**",
    "**.exe",
    "**.zip",
    "**.apk",
)


def host_globs(host: str, path: str) -> tuple[str, str]:
    return f"{host}{path}**", f"*.{host}{path}**"


class Automaton:
    """`globs` packed into 64-bit words."""

    def __init__(self, globs: list[str]) -> None:
        runs = [self._states(g) for g in globs]
        size = sum(len(r) for r in runs)
        self.words = max(1, -(-size // 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        bit = 0
        for run in runs:
            self._set(self.start, bit)
            for enter, stay in run:
                for byte in enter:
                    self._set(self.enter[byte], bit)
                for byte in stay:
                    self._set(self.stay[byte], bit)
                bit += 1
            self.final.append((*divmod(bit - 1, 64),))
        self.final = [(w, np.uint64(1 << b)) for w, b in self.final]

    @staticmethod
    def _set(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1 << (bit % 64))

    @staticmethod
    def _states(glob: str) -> list[tuple[set[int], set[int]]]:
        """(bytes that enter the state, bytes that stay in it), state 0 first."""
        every, segment = set(range(256)), set(range(256)) - {0x2F}
        states: list[tuple[set[int], set[int]]] = [(set(), set())]
        raw, i = glob.encode(), 0
        while i < len(raw):
            if raw[i : i + 2] == b"**":
                states[-1] = (states[-1][0], every)
                i += 2
            elif raw[i : i + 1] == b"*":
                states[-1] = (states[-1][0], states[-1][1] | segment)
                i += 1
            else:
                states.append((segment if raw[i : i + 1] == b"?" else {raw[i]}, set()))
                i += 1
        return states

    def matches(self, urls: pa.Array) -> np.ndarray:
        """Boolean matrix, a row per URL and a column per pattern; null matches like the empty text."""
        binary = urls.cast(pa.large_binary()).fill_null(b"")
        n = len(binary)
        if not n:
            return np.zeros((0, len(self.final)), bool)
        offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + n + 1]
        data = np.frombuffer(binary.buffers()[2], np.uint8) if offsets[-1] else np.zeros(0, np.uint8)
        order = np.argsort(offsets[:-1] - offsets[1:], kind="stable")  # longest first
        begin, length = offsets[:-1][order], np.diff(offsets)[order]
        state = np.tile(self.start, (n, 1))
        active = n
        for step in range(int(length[0])):
            while active and length[active - 1] <= step:
                active -= 1
            byte = data[begin[:active] + step]
            now = state[:active]
            moved = now << np.uint64(1)
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.enter[byte]) | (now & self.stay[byte])
        found = np.empty((n, len(self.final)), bool)
        for k, (word, bit) in enumerate(self.final):
            found[order, k] = (state[:, word] & bit) != 0
        return found


def host_of(url: Column) -> Column:
    """Text after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    return F.when(at > 0, F.substr(whole, at + 3)).otherwise(F.lit(""))


def judge_urls(
    pages: DataFrame,
    host_rules: tuple[tuple[str, str, str], ...] = HOST_RULES,
    block_globs: tuple[str, ...] = BLOCK_GLOBS,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, blocked_by: one row per input row.

    rule is the longest fitting host rule as `host` + `path`, null if none fits; its verdict holds. Without one, a URL
    that one of `block_globs` matches is blocked, with blocked_by the first of them, and any other is allowed. A null URL
    and one without `://` have an empty host and path and are allowed unless a glob matches the empty text. Repeated
    rows and null ids are judged like any other; other columns are not looked at.
    """
    ranked = sorted(host_rules, key=lambda r: -len(r[1] + r[2]))
    globs = [g for _, host, path in ranked for g in host_globs(host, path)] + list(block_globs)
    texts = [host + path for _, host, path in ranked]
    verdicts = [verdict for verdict, _, _ in ranked]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        none = len(ranked)
        names = pa.array([*texts, None], pa.string())
        own = pa.array([*block_globs, None], pa.string())
        for batch in batches:
            found = automaton.matches(batch.column("canonical"))
            hosts = found[:, : 2 * none].reshape(len(found), none, 2).any(axis=2)
            rule = np.where(hosts.any(axis=1), hosts.argmax(axis=1), none) if none else np.zeros(len(found), int)
            blocked = found[:, 2 * none :]
            hit = blocked.any(axis=1) if blocked.shape[1] else np.zeros(len(found), bool)
            glob = np.where(hit & (rule == none), blocked.argmax(axis=1) if blocked.shape[1] else 0, len(block_globs))
            said = np.array([*verdicts, ""], dtype=object)[rule]
            said = np.where(rule == none, np.where(hit, "block", "allow"), said)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("host"),
                    batch.column("path"),
                    names.take(pa.array(rule)),
                    pa.array(said, pa.string()),
                    own.take(pa.array(glob)),
                ],
                ["page_id", "host", "path", "rule", "verdict", "blocked_by"],
            )

    url = F.col(url_col)
    seen = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    seen = seen.withColumn("canonical", F.concat("host", "path"))
    kind = seen.schema["page_id"].dataType.simpleString()
    return seen.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string, blocked_by string")


def op5_url_filters(spark, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"))


def _like(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


def _regex(glob: str) -> str:
    out, i = "", 0
    while i < len(glob):
        if glob[i : i + 2] == "**":
            out, i = out + "(.|\\n)*", i + 2
        else:
            out += "[^/]*" if glob[i] == "*" else "[^/]" if glob[i] == "?" else "[.]" if glob[i] == "." else glob[i]
            i += 1
    return out


def _oracle() -> str:
    ranked = sorted(HOST_RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {_like(h, p)} THEN '{h}{p}'" for _, h, p in ranked)
    verdict = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for v, h, p in ranked)
    glob = " ".join(f"WHEN regexp_full_match(host || path, '{_regex(g)}') THEN '{g}'" for g in BLOCK_GLOBS)
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, CASE {rule} END AS rule FROM parts),
globbed AS (SELECT *, CASE WHEN rule IS NULL THEN CASE {glob} END END AS blocked_by FROM ruled)
SELECT page_id, host, path, rule, CASE {verdict} WHEN blocked_by IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, blocked_by
FROM globbed
"""


QUERIES = {"op5_url_filters": op5_url_filters}
ORACLE = {"op5_url_filters": _oracle()}
