"""URL rules as globs, matched all at once by a bit-parallel automaton.

A url is judged in canonical form, '.' + host + path.  In a glob '*' stands for
any bytes but '/', '**' for any bytes.  All globs are packed into one row of
64-bit words, a bit per glob byte; reading a byte of the url shifts the row
(with carries between words), masks it by that byte, and keeps the bits that a
star may hold.  The urls of a batch step through their bytes together.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import flat, steps


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self):
        return self.host + self.path

    @property
    def glob(self):
        # A single star: the rule's host must not be found within a path.
        return f"*.{self.host}{self.path}**"


#: Rules by host and path; the longest that fits decides.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))
#: Globs that block where no rule fits: hosts named for gambling, cheap drugs and the like, and paths to log-ins and programs.
BLOCK_GLOBS = ("*casino*", "*casino*/**", "*free-bets*", "*free-bets*/**", "*cheap-pills*", "*cheap-pills*/**", "**/login/**", "**/wp-admin/**", "**.exe", "**.apk")


class Automaton:
    """Many globs over bytes as one Shift-And row of several words."""

    def __init__(self, globs):
        width = sum(len(self._tokens(g)) + 1 for g in globs)
        self.words = max(1, -(-width // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.hold = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.accept = []
        bit = 0
        not_slash = [c for c in range(256) if c != ord("/")]
        for glob in globs:
            self.start[bit >> 6] |= np.uint64(1 << (bit & 63))
            for token in self._star_after(glob):
                kind, star = token
                if kind is not None:
                    bit += 1
                    self.step[kind, bit >> 6] |= np.uint64(1 << (bit & 63))
                for c in range(256) if star == 2 else not_slash if star == 1 else ():
                    self.hold[c, bit >> 6] |= np.uint64(1 << (bit & 63))
            self.accept.append(bit)
            bit += 1

    @staticmethod
    def _tokens(glob):
        return glob.encode().replace(b"*", b"")

    @staticmethod
    def _star_after(glob):
        """(None or byte, star that follows it: 0, 1 for '*', 2 for '**'), the first for the place before all bytes."""
        raw, out, i = glob.encode(), [[None, 0]], 0
        while i < len(raw):
            if raw[i] == 42:
                double = raw[i + 1:i + 2] == b"*"
                out[-1][1] = max(out[-1][1], 2 if double else 1)
                i += 2 if double else 1
            else:
                out.append([raw[i], 0])
                i += 1
        return out

    def match(self, data, offsets):
        """A row of flags per text: which globs fit it as a whole."""
        n = len(offsets) - 1
        row = np.tile(self.start, (n, 1))
        lengths = np.diff(offsets)
        by_length = np.argsort(-lengths, kind="stable")
        longest_first = -lengths[by_length]
        for at in range(int(lengths.max()) if n else 0):
            # Texts longer than ``at`` are a prefix of the order.
            live = by_length[:np.searchsorted(longest_first, -at, "left")]
            byte = data[offsets[live] + at]
            now = row[live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            row[live] = moved & self.step[byte] | now & self.hold[byte]
        return np.stack([(row[:, b >> 6] >> np.uint64(b & 63) & np.uint64(1)).astype(bool) for b in self.accept], 1) if self.accept else np.zeros((n, 0), bool)


def split_url(docs: DataFrame, url_col="url") -> DataFrame:
    """``docs`` with ``host`` (A-Z lower-cased) and ``path``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rest = F.expr(f"case when instr(`{url_col}`, '://') > 0 then substring(`{url_col}`, instr(`{url_col}`, '://') + 3) else '' end")
    first = lambda column, *marks: first(F.substring_index(column, marks[0], 1), *marks[1:]) if marks else column
    host = first(rest, "/", "?", "#")
    behind = F.substr(rest, F.length(host) + 1)
    return docs.withColumns({"host": F.translate(host, upper, lower), "path": first(behind, "?", "#")})


def _judge(names, rules, globs):
    ordered = sorted(rules, key=lambda r: -len(r.text))
    automaton = Automaton([r.glob for r in ordered] + list(globs))

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(len(names)))
            rule, verdict = [], []
            for i, j in steps(offsets):
                fits = automaton.match(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                own = np.concatenate([fits[:, :len(ordered)], np.ones((j - i, 1), bool)], 1).argmax(1)
                blocked = fits[:, len(ordered):].any(1)
                rule += [ordered[k].text if k < len(ordered) else None for k in own.tolist()]
                verdict += [ordered[k].verdict if k < len(ordered) else "block" if b else "allow" for k, b in zip(own.tolist(), blocked.tolist(), strict=True)]
            columns = [batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[*names, "rule", "verdict"])

    return run


def judge(pages: DataFrame, id_col="page_id", url_col="url", rules=RULES, block_globs=BLOCK_GLOBS) -> DataFrame:
    """(id_col, host, path, rule, verdict) of every row.

    ``rules`` fit a host and its subdomains if the path starts with the
    rule's; the longest text wins, of equal ones the first.  Where none fits,
    rule is null and a url that one of ``block_globs`` fits is blocked, any
    other allowed.  A null url, or one without '://', has an empty host and
    path and is judged as such.  No rows are dropped; repeated rows are judged
    each.
    """
    split = split_url(pages.select(F.col(id_col), F.col(url_col).alias("_url")), "_url")
    kind = split.schema[id_col].dataType.simpleString()
    source = split.select(id_col, "host", "path", F.concat(F.lit("."), "host", "path").alias("canonical"))
    names = [id_col, "host", "path"]
    return source.mapInArrow(_judge(names, tuple(rules), tuple(block_globs)), f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def keep_allowed(pages: DataFrame, url_col="url", **options) -> DataFrame:
    """The rows of ``pages`` whose url is allowed."""
    split = split_url(pages.select(F.struct("*").alias("_row"), F.col(url_col).alias("_url")), "_url")
    source = split.select("_row", "host", "path", F.concat(F.lit("."), "host", "path").alias("canonical"))
    kind = source.schema["_row"].dataType.simpleString()
    run = _judge(["_row", "host", "path"], tuple(options.get("rules", RULES)), tuple(options.get("block_globs", BLOCK_GLOBS)))
    judged = source.mapInArrow(run, f"_row {kind}, host string, path string, rule string, verdict string")
    return judged.where("verdict = 'allow'").select("_row.*")
