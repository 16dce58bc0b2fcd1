"""Main texts of web pages through wrappers: union-free regular expressions inferred per host.

A page is read as a stream of tokens: opening and closing tags of blocks, with
their class, id and role, and texts.  (Inline tags, comments, scripts, styles
and the like are no tokens; missing end tags are put in.)  A wrapper describes
all pages of a host: a nested sequence of elements, text slots, optional items
``(..)?`` and repeated groups ``(..)+``, without alternatives.  It is inferred
by alignment:

* two streams are aligned level by level; what only one has becomes optional,
  and aligned elements are aligned inside;
* a token that comes up again at its level shows a repetition: what lies
  between two of its occurrences are turns of one group, which are aligned with
  each other in the same way;
* texts become slots.  A slot counts its pages, characters and characters in
  links, and remembers its text as long as all pages have the same.

So a tag stands only once at each level of a wrapper, and a path of tags names a
slot; wrappers of the same pages have the same slots whatever the order of the
alignments.  Elements nested deeper than ``DEPTH`` count as part of the one at
that depth.  That makes wrappers mergeable: a task aligns the pages of a batch
(each distinct stream once) into one wrapper per host, and those are aligned in
rounds of at most ``FAN`` per group, so a host with a third of all pages is never
in one task.

The wrapper tells which slots hold the article.  Slots under navigation,
headers, footers, sidebars, adverts, notices, comments or forms (by tag, role,
class or id) never do.  Of the others those inside of an article or main element
do; pages without such an element give the texts of all other slots but those
that are mostly links, or the same on all pages of the host.  Then the pages are
read against their host's wrapper.

Cases: null and empty html give an empty text, a null URL or one without a host
belongs to the empty host, broken markup (tags or comments cut off, stray end
tags, unbalanced quotes) is read as browsers do, repeated rows are pages of
their own, an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adevents.llm.common import saved
from adevents.llm.contamination import _slices as slices_of
from adevents.llm.url_filter import host_of

FAN = 64
SLICE_BYTES = 8 << 20
#: Slots of a host are broadcast up to so many bytes, else joined.
BROADCAST_BYTES = 32 << 20
SALTS = 64
#: Elements within so many others are read as part of the innermost of those.
DEPTH = 100
#: A text on all of so many pages, or more, belongs to the template.
SAME_ON = 3

# HTML's elements by their part in the layout of text.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes noscript object script style svg template textarea title xmp".split())
_CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]), "body": frozenset(["head"]),
}
_SCOPE = frozenset("ul ol dl table tbody thead tfoot html body".split())
# What is not an article, by tag, and by words of class, id and role.
_APART_TAGS = frozenset("aside button dialog fieldset footer form head header label legend menu nav option select".split())
_APART_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts alert author-box banner breadcrumb breadcrumbs comment comments"
    " complementary consent contentinfo cookie cookies copyright dialog disqus footer form gdpr header login masthead menu"
    " modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion"
    " related reply replies respond search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
_MAIN_TAGS = frozenset(["article", "main"])
_MAIN_WORDS = frozenset(["main", "article", "articlebody", "article-body", "entry-content", "post-content", "main-content"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^'">]++)*+>|</?[a-zA-Z][^>]*>|<[!?][^>]*>|<(?=[a-zA-Z/!?])[^>]*\Z""",
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""\s(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in _RAW}
TEXT, CLOSE = "#", "/"
_PATH = "\x1f"


# ---- pages as tokens -----------------------------------------------------------


@lru_cache(1 << 14)
def _tag(token: str) -> tuple[str, str]:
    """A tag's name and, for opening tags, its key: name and the words of its marks."""
    name = _NAME.match(token)[1].lower()
    words: set[str] = set()
    if not token.startswith("</"):
        for mark, value in _MARKS.findall(token):
            sign = {"class": ".", "id": "#", "role": "@", "itemprop": "@"}[mark.lower()]
            words.update(sign + re.sub(r"\d+", "", w) for w in value.strip("\"'").lower().split())
    return name, name + "".join(sorted(w.replace(_PATH, "") for w in words))


class Page:
    """A page's tokens (keys of opening tags, ``/``, ``#``) and its texts with their characters in links."""

    __slots__ = ("tokens", "texts", "linked", "_run", "_run_linked")

    def __init__(self, source: str):
        self.tokens: list[str] = []
        self.texts: list[str] = []
        self.linked: list[int] = []
        self._run: list[str] = []
        self._run_linked = 0
        self._read(source)

    def _add(self, text: str, in_link: bool) -> None:
        if text:
            text = entities.unescape(text) if "&" in text else text
            self._run.append(text)
            if in_link:
                self._run_linked += len(text)

    def _flush(self) -> None:
        if self._run:
            text = " ".join("".join(self._run).split())
            if text:
                self.tokens.append(TEXT)
                self.texts.append(text)
                self.linked.append(min(self._run_linked, len(text)))
            self._run, self._run_linked = [], 0

    def _read(self, source: str) -> None:
        stack: list[str] = []
        too_deep: list[str] = []
        at, in_link, tokens = 0, False, self.tokens
        while True:
            found = _TOKEN.search(source, at)
            if found is None:
                self._add(source[at:], in_link)
                break
            if found.start() > at:
                self._add(source[at : found.start()], in_link)
            at = found.end()
            token = found[0]
            if token[1] in "!?" or not token.endswith(">"):
                continue
            closing = token[1] == "/"
            if closing and not token[2:3].isalpha():
                continue
            name, key = _tag(token)
            if name in _RAW:
                if not closing:
                    if not token.endswith("/>") or name in ("script", "style", "title", "textarea"):
                        end = _RAW_END[name].search(source, at)
                        at = end.end() if end else len(source)
                    if name not in ("svg",):
                        self._flush()
                continue
            if name == "br":
                self._run.append(" ")
                continue
            if name in _INLINE:
                if name == "a":
                    in_link = not closing
                continue
            self._flush()
            in_link = False
            if closing:
                if name in too_deep:
                    del too_deep[too_deep.index(name) :]
                elif name in stack:
                    while True:
                        tokens.append(CLOSE)
                        if stack.pop() == name:
                            break
                continue
            if name in _VOID:
                continue
            # end tags that were left out
            if "p" in stack:
                i = len(stack) - 1
                while stack[i] != "p" and stack[i] not in ("td", "th", "li", "dd", "dt", "blockquote", "button"):
                    i -= 1
                if stack[i] == "p":
                    tokens.extend([CLOSE] * (len(stack) - i))
                    del stack[i:]
            if closes := _CLOSED_BY.get(name):
                i = len(stack) - 1
                while i >= 0 and stack[i] not in closes and stack[i] not in _SCOPE:
                    i -= 1
                if i >= 0 and stack[i] in closes:
                    while i > 0 and stack[i - 1] in closes and name == "tr":  # a cell and its row
                        i -= 1
                    tokens.extend([CLOSE] * (len(stack) - i))
                    del stack[i:]
            if name in ("html", "body") and name in stack:
                continue
            if len(stack) >= DEPTH:
                too_deep.append(name)
                continue
            stack.append(name)
            tokens.append(key)
        self._flush()
        tokens.extend([CLOSE] * len(stack))


def slot_paths(tokens: Iterable[str]) -> list[str]:
    """The path of each text of a token stream."""
    out, path = [], [""]
    for token in tokens:
        if token == TEXT:
            out.append(path[-1])
        elif token == CLOSE:
            path.pop()
        else:
            path.append(path[-1] + _PATH + token)
    return out


# ---- wrappers --------------------------------------------------------------------


class Item:
    """A part of a wrapper: an element (``key``, ``body``), a slot (``#``, ``facts``) or a group (no key).

    A slot's facts are its pages, characters, characters in links, and its text's
    checksum as long as it has only one (else -1).
    """

    __slots__ = ("key", "body", "facts", "optional", "repeated")

    def __init__(self, key, body=None, facts=None, optional=False, repeated=False):
        self.key, self.body, self.facts, self.optional, self.repeated = key, body, facts, optional, repeated

    def keys(self) -> set[str]:
        return {k for x in self.body for k in x.keys()} if self.key is None else {self.key}

    def dump(self) -> list:
        body = None if self.body is None else [x.dump() for x in self.body]
        return [self.key, body, self.facts, int(self.optional), int(self.repeated)]

    @classmethod
    def load(cls, data: list) -> Item:
        key, body, facts, optional, repeated = data
        return cls(key, None if body is None else [cls.load(x) for x in body], facts, bool(optional), bool(repeated))


def _same_facts(a: list[int], b: list[int]) -> list[int]:
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] if a[3] == b[3] else -1]


def unify(a: Item, b: Item) -> Item:
    """One item for two aligned slots, or elements of one key."""
    optional = a.optional or b.optional
    repeated = a.repeated or b.repeated
    if a.key == TEXT:
        return Item(TEXT, None, _same_facts(a.facts, b.facts), optional, repeated)
    return Item(a.key, align(a.body, b.body), None, optional, repeated)


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """The wrapper of what two wrappers of one level describe."""
    if len(a) == len(b) and all(x.key is not None and x.key == y.key for x, y in zip(a, b)):
        return [unify(x, y) for x, y in zip(a, b)]
    ka, kb = [x.keys() for x in a], [x.keys() for x in b]
    # Longest common subsequence of items that share a key.
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + 1 if ka[i] & kb[j] else 0)
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if ka[i] & kb[j] and best[i][j] == best[i + 1][j + 1] + 1:
            if a[i].key is not None and b[j].key is not None:
                out.append(unify(a[i], b[j]))
                i, j = i + 1, j + 1
                continue
            # A turn of the group on one side is a run of items on the other.
            keys, p, q = ka[i] | kb[j], i + 1, j + 1
            while a[i].key is not None and p < len(a) and ka[p] & keys:
                p += 1
            while b[j].key is not None and q < len(b) and kb[q] & keys:
                q += 1
            one, two = ([y for x in run for y in (x.body if x.key is None else [x])] for run in (a[i:p], b[j:q]))
            optional = all(x.optional for x in a[i:p]) or all(x.optional for x in b[j:q])
            out.append(Item(None, align(fold(one), fold(two)), None, optional, True))
            i, j = p, q
        elif best[i][j] == best[i + 1][j]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    out += [_optional(x) for x in a[i:] + b[j:]]
    return fold(out)


def _optional(x: Item) -> Item:
    return Item(x.key, x.body, x.facts, True, x.repeated)


def fold(items: list[Item]) -> list[Item]:
    """Repetitions as groups, so that every key stands once."""
    out: list[Item] = []
    for x in items:  # neighbours of one key
        if out and x.key is not None and out[-1].key == x.key:
            both = unify(out[-1], x)
            both.repeated, both.optional = True, out[-1].optional and x.optional
            out[-1] = both
        else:
            out.append(x)
    last: dict[str, int] = {}
    for i, x in enumerate(out):
        for k in x.keys():
            last[k] = i
    done: list[Item] = []
    i = 0
    while i < len(out):
        end = max(last[k] for k in out[i].keys())
        if end == i:
            done.append(out[i])
            i += 1
            continue
        j, again = i, [k for k in out[i].keys() if last[k] > i]
        while j <= end:  # everything up to the last key that begins in the range
            end = max(end, max(last[k] for k in out[j].keys()))
            j += 1
        turns: list[list[Item]] = []
        for x in out[i : end + 1]:
            if not turns or x.keys() & set(again):
                turns.append([])
            turns[-1].extend(x.body if x.key is None else [x])
        body = fold(turns[0])
        for turn in turns[1:]:
            body = align(body, fold(turn))
        optional = all(x.optional for x in out[i : end + 1])
        if len(body) == 1:
            done.append(Item(body[0].key, body[0].body, body[0].facts, optional, True))
        else:
            done.append(Item(None, body, None, optional, True))
        i = end + 1
    return done


def wrapper_of(tokens: Iterable[str], facts: Iterable[list[int]]) -> list[Item]:
    """The wrapper of one token stream; ``facts`` are those of its texts."""
    facts = iter(facts)
    levels: list[list[Item]] = [[]]
    for token in tokens:
        if token == TEXT:
            levels[-1].append(Item(TEXT, None, next(facts)))
        elif token == CLOSE:
            body = levels.pop()
            levels[-1][-1].body = fold(body)
        else:
            levels[-1].append(Item(token, []))
            levels.append([])
    return fold(levels[0])


def pattern(items: list[Item]) -> str:
    """The wrapper as a regular expression, with ``#`` for slots."""
    out = []
    for x in items:
        name = x.key
        text = TEXT if name == TEXT else pattern(x.body) if name is None else f"<{name}>{pattern(x.body)}</>"
        sign = ("*" if x.optional else "+") if x.repeated else "?" if x.optional else ""
        out.append(f"({text}){sign}" if sign else text)
    return "".join(out)


def describes(items: list[Item], tokens: list[str]) -> bool:
    """Whether every token of a stream has its place in the wrapper (order and counts aside)."""
    path: list[dict] = [_by_key(items)]
    for token in tokens:
        if token == CLOSE:
            path.pop()
        elif token not in path[-1]:
            return False
        elif token != TEXT:
            path.append(_by_key(path[-1][token].body))
    return True


def _by_key(items: list[Item]) -> dict[str, Item]:
    out: dict[str, Item] = {}
    for x in items:
        out.update(_by_key(x.body) if x.key is None else {x.key: x})
    return out


# ---- which slots hold the article -------------------------------------------------


def _name(key: str) -> str:
    return re.split(r"[.#@]", key, maxsplit=1)[0]


def _words(key: str) -> list[str]:
    return re.split(r"[.#@]", key)[1:]


def _is_apart(key: str) -> bool:
    name = _name(key)
    if name in ("html", "body"):
        return False
    if name in _APART_TAGS:
        return True
    for word in _words(key):
        if word in _APART_WORDS:
            return True
        parts = [p for p in re.split(r"[-_]+", word) if p]
        if name not in _MAIN_TAGS and parts and (parts[0] in _APART_WORDS or parts[-1] in _APART_WORDS):
            return True
    return False


def _is_main(key: str) -> bool:
    return _name(key) in _MAIN_TAGS or any(w in _MAIN_WORDS for w in _words(key))


def _holds_main(items: list[Item]) -> bool:
    return any(_holds_main(x.body) or (x.key is not None and _is_main(x.key)) for x in items if x.key != TEXT)


def slots(items: list[Item]) -> tuple[list[str], list[str]]:
    """Paths of the slots inside of articles, and of the others that may hold the article of a page without one."""
    main: list[str] = []
    other: list[tuple[str, list[int]]] = []

    def walk(items: list[Item], path: str, inside: bool, heading_only: bool) -> None:
        for x in items:
            if x.key is None:
                walk(x.body, path, inside, heading_only)
            elif x.key == TEXT:
                if heading_only and _name(path.rsplit(_PATH, 1)[-1]) not in _HEADINGS:
                    continue
                if inside:
                    main.append(path)
                else:
                    other.append((path, x.facts))
            else:
                only = heading_only
                if _is_apart(x.key) and not _holds_main(x.body):
                    if not (inside and _name(x.key) == "header"):
                        continue
                    only = True  # an article's own header: its headings stay
                walk(x.body, path + _PATH + x.key, inside or _is_main(x.key), only)

    walk(items, "", False, False)
    running = [(p, f) for p, f in other if 2 * f[2] <= f[1]]
    varied = [(p, f) for p, f in running if not (f[0] >= SAME_ON and f[3] != -1)]
    return main, [p for p, _ in varied or running]


# ---- on Spark ----------------------------------------------------------------------


def _facts(text: str, linked: int) -> list[int]:
    return [1, len(text), linked, zlib.crc32(text.encode("utf-8", "surrogatepass"))]


def _pages(batch: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    for i, source in enumerate(batch.column("html").to_pylist()):
        yield i, source or ""


def _merge(wrappers: Iterable[list[Item]]) -> list[Item]:
    out: list[Item] | None = None
    for w in wrappers:
        out = w if out is None else align(out, w)
    return out or []


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, pages, wrapper`` (JSON) of every host of ``pages(url, html)``."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _html_slices(whole):
                streams: dict[tuple[str, str], list] = {}
                hosts = batch.column("host").to_pylist()
                for i, source in _pages(batch):
                    page = Page(source)
                    facts = [_facts(t, n) for t, n in zip(page.texts, page.linked)]
                    key = (hosts[i], "\n".join(page.tokens))
                    held = streams.get(key)
                    if held is None:
                        streams[key] = [1, page.tokens, facts]
                    else:
                        held[0] += 1
                        held[2] = [_same_facts(a, b) for a, b in zip(held[2], facts)]
                by_host: dict[str, list] = {}
                for (host, _), (n, tokens, facts) in sorted(streams.items(), key=lambda x: x[0]):
                    entry = by_host.setdefault(host, [0, []])
                    entry[0] += n
                    entry[1].append(wrapper_of(tokens, facts))
                yield _wrapper_batch([(h, n, _merge(w)) for h, (n, w) in by_host.items()])

    def of_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("wrapper", "ascending")])
        merged = _merge([Item.load(x) for x in json.loads(w)] for w in rows.column("wrapper").to_pylist())
        return pa.Table.from_batches([_wrapper_batch([(rows.column("host")[0].as_py(), sum(rows.column("pages").to_pylist()), merged)])])

    schema = "host string, pages long, wrapper string"
    found = saved(pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(of_batches, schema), "wrappers")
    while True:
        most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return found
        group = F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(-(-most // FAN)))
        found = saved(found.withColumn("nth", group).groupBy("host", "nth").applyInArrow(of_group, schema), "wrappers")


def _html_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    renamed = batch.rename_columns(["text" if c == "html" else c for c in batch.schema.names])
    for part in slices_of(renamed, SLICE_BYTES):
        yield part.rename_columns(batch.schema.names)


def _wrapper_batch(rows: list[tuple[str, int, list[Item]]]) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "host": pa.array([h for h, *_ in rows], pa.string()),
            "pages": pa.array([n for _, n, _ in rows], pa.int64()),
            "wrapper": pa.array([json.dumps([x.dump() for x in w]) for *_, w in rows], pa.string()),
        }
    )


def wrapper_slots(wrappers: DataFrame) -> DataFrame:
    """``host, slots``: the paths of each host's article slots, and of those for pages without an article."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [json.dumps(slots([Item.load(x) for x in json.loads(w)])) for w in batch.column("wrapper").to_pylist()]
            yield pa.record_batch({"host": batch.column("host"), "slots": pa.array(chosen, pa.string())})

    return wrappers.select("host", "wrapper").mapInArrow(choose, "host string, slots string")


def read_page(source: str, main: frozenset[str], other: frozenset[str]) -> str:
    """The text of a page in the given slots, one line per block."""
    page = Page(source)
    paths = slot_paths(page.tokens)
    chosen = main if any(p in main for p in paths) else other
    return "\n".join(t for t, p in zip(page.texts, paths) if p in chosen)


@lru_cache(4096)
def _slot_sets(chosen: str) -> tuple[frozenset[str], frozenset[str]]:
    main, other = json.loads(chosen)
    return frozenset(main), frozenset(other)


def extract(pages: DataFrame, wrappers: DataFrame | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``page_id, url, host, text`` of every page; wrappers are inferred from ``pages`` unless given."""
    chosen = saved(wrapper_slots(infer_wrappers(pages) if wrappers is None else wrappers), "slots")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    size = chosen.agg(F.sum(F.octet_length("host") + F.octet_length("slots"))).first()[0] or 0
    names = ["page_id", "url", "host", "text"]
    schema = "page_id long, url string, host string, text string"
    if size <= broadcast_bytes:
        by_host = pages.sparkSession.sparkContext.broadcast({r.host: r.slots for r in chosen.collect()})
        nowhere = json.dumps([[], []])
    else:
        salted = chosen.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
        rows = rows.withColumn("salt", salt).join(salted, ["host", "salt"]).drop("salt")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _html_slices(whole):
                hosts = batch.column("host").to_pylist()
                if "slots" in batch.schema.names:
                    of = batch.column("slots").to_pylist()
                else:
                    held = by_host.value
                    of = [held.get(h, nowhere) for h in hosts]
                texts = [read_page(source, *_slot_sets(of[i])) for i, source in _pages(batch)]
                kept = [batch.column("page_id").cast(pa.int64()), batch.column("url"), batch.column("host")]
                yield pa.record_batch([*kept, pa.array(texts, pa.string())], names=names)

    return rows.mapInArrow(read, schema)


def extraction_digest(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, host`` of every page."""
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "host")
