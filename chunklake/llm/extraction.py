"""HTML extraction: structure where a page declares it, a suffix array of the host's token streams where it does not.

A page's text outside its article (all of its text, if it declares none) is a stream of words and block marks. The streams of a
host's pages are concatenated and their suffixes sorted to the depth of a run; neighbours that agree over a whole run, from
three different streams or more, are a repeated run. The pages of a host that is too large for one task are dealt into lots; no
suffix array is built for it: its runs are the hashes of all stretches of a run's words, counted in Spark over the whole host,
which finds the same runs but for collisions. Of blocks that mostly lie in repeated runs these go; what only one page has
stays. Text inside a declared article is never removed for being repeated: licence lines and copied passages
repeat across pages, too, and are part of the article.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import in_small_batches, kept
from chunklake.llm.urls import host_of

#: Words and marks of a run; streams that must share it; share of a block's words in runs that makes it boilerplate.
RUN, MIN_STREAMS, COVERED = 8, 3, 0.5
#: A host whose pages have more bytes is dealt into lots of about so many; and bytes of a shuffle partition.
LOT_BYTES, PARTITION_BYTES = 4 << 20, 32 << 20
#: Runs of a host of several lots are told by a polynomial in this over the hashes of their words.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|iframe|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are followed to their end; others cannot hold a block that matters.
_FOLLOWED = frozenset("article aside blockquote body details dialog div dl fieldset figure footer form head header html main menu nav ol section span table td ul".split())
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd".split())
_BOILERPLATE = frozenset("aside dialog fieldset footer form head menu nav".split())
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
    "footer form gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted "
    "promotion related replies respond search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription toolbar widget widgets".split()
)
#: Elements whose text is none of the page's, up to their end or their parent's; the first part the words around them.
_SKIPPED = {"noscript": " ", "template": " ", "select": " ", "object": " ", "canvas": " ", "video": " ", "audio": " "}
_SKIPPED |= {"svg": "", "button": "", "annotation": "", "annotation-xml": ""}
#: Where a class begins so, it tells what a page is about or has, not what the element is.
_ABOUT = frozenset("has no not with without tag category cat type format status is js lang language author single".split())
#: Articles in elements marked so are other texts; in others the marks do not count.
_OTHERS = frozenset("comment comments disqus related replies respond".split())
_STRENGTH = ("", "mark", "others", "element")
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

ARTICLE, OPEN, DROPPED = 0, 1, 2


def _marks(value: str, inside: bool) -> set[str]:
    """The marks in a class or id: a name made of them alone or, outside of articles, that begins or ends with one."""
    found = set()
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if inside:
            found |= set(words) if set(words) <= _MARKS else set()
        elif words and words[0] not in _ABOUT:
            found |= {words[0], words[-1]} & _MARKS
            if "header" in found and {"article", "entry", "post", "content"} & set(words):
                found.discard("header")
    return found


def _is_boilerplate(name: str, attributes: str, inside: bool = False) -> str:
    """What tells that an element is no part of the text: ``element`` by its role or state, ``others`` or ``mark`` by its class or id.

    ``inside`` an article only names made of nothing but marks tell.
    """
    if not attributes or attributes.isspace():
        return ""
    found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")):
        return "element"
    if found.get("role", "").lower() in _ROLES:
        return "element"
    if name in ("html", "body", "main"):
        return ""
    if name == "article":
        return "others" if _OTHERS & set(found.get("class", "").lower().split()) else ""
    marks = _marks(found.get("class", ""), inside) | _marks(found.get("id", ""), inside)
    if "header" in marks and {w.lower() for w in _WORDS.findall(found.get("class", ""))} & {"article", "entry", "post", "content"}:
        marks.discard("header")
    return "others" if marks & _OTHERS else "mark" if marks else ""


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order, with one space between words; blocks without text are left out.

    ``ARTICLE``: within an article, or the main element of a page without one; ``DROPPED``: within a menu, header, footer, sidebar,
    notice, advert, form or comments, told by the element, its role, class or id; ``OPEN``: neither.
    """
    found: list[tuple[int, str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, str, int]] = [("", "", 0)]  # element, what drops it, 1 in a main element, 2 in an article
    para: tuple[str, str] = ("", "")
    skipped: list[str] = []  # open elements without text
    inner: list[str] = []  # open elements within them
    at = 0

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, drops, where = stack[-1]
                found.append((DROPPED if drops or para[1] else OPEN, text, where))

    for match in _TOKEN.finditer(page):
        start, end = match.span()
        if start > at and not skipped:
            parts.append(page[at:start])
        at = end
        name = match[3] or match[6]
        if not name:
            if match[1] and not skipped:
                parts.append(" ")
            continue
        name, ends, attributes = name.lower(), bool(match[2] or match[5]), match[4] or match[7] or ""
        if name in _SKIPPED:
            if not ends and not attributes.rstrip().endswith("/"):
                if not skipped:
                    parts.append(_SKIPPED[name])
                    inner = []
                skipped.append(name)
            elif ends and name in skipped:
                while skipped.pop() != name:
                    pass
            continue
        if skipped:
            # what it holds is passed over; the end of an element around it ends it
            if ends and name in inner:
                while inner.pop() != name:
                    pass
                continue
            around = any(s[0] == name for s in stack) or name == para[0]
            if not (ends and around):
                if not ends and (name in _FOLLOWED or name in _PARAGRAPHS) and not attributes.rstrip().endswith("/"):
                    inner.append(name)
                continue
            skipped.clear()
        if name == "br":
            parts.append("\n")
        if name not in _BLOCKS and name != "span":
            continue
        if name != "span":
            close()
        if name in _PARAGRAPHS:
            para = ("", "") if ends else (name, _is_boilerplate(name, attributes, stack[-1][2] == 2))
        elif name in _FOLLOWED:
            if name != "span":
                para = ("", "")
            if ends:
                if any(s[0] == name for s in stack):
                    if name == "span" and stack[-1][0] == "span" and stack[-1][1]:
                        close()
                    while stack.pop()[0] != name:
                        pass
            elif not attributes.rstrip().endswith("/"):
                _, drops, where = stack[-1]
                main = name == "main" or (where == 0 and bool(re.search(r"role\s*=\s*[\"']?main\b", attributes)))
                # what holds the article is more than its class says
                if name == "body" or (drops == "mark" and where < 2 and (main or name == "article")):
                    drops = ""
                if name in _BOILERPLATE or (name == "header" and not where):
                    own = "element"
                else:
                    own = _is_boilerplate(name, attributes, where == 2)
                if name == "span":
                    if not own:
                        stack.append((name, drops, where))
                        continue
                    close()
                if name == "article":
                    where = 2
                elif main:
                    where = max(where, 1)
                stack.append((name, max(drops, own, key=_STRENGTH.index), where))
    if not skipped:
        parts.append(page[at:])
    close()
    best = max((w for k, _, w in found if k == OPEN), default=0)
    return [(ARTICLE if k == OPEN and best and w >= best else DROPPED if k == OPEN and best else k, text) for k, text, w in found]


def repeated(streams: list[np.ndarray], run: int = RUN, least: int = MIN_STREAMS) -> list[np.ndarray]:
    """Which tokens of each stream lie in a run that so many different streams have.

    The suffixes of all streams together are sorted to depth ``run``, a power of two, by doubling ranks.
    """
    sizes = np.array([len(s) for s in streams], np.int64)
    # copies of one stream are no evidence: alike streams have one number
    alike: dict[bytes, int] = {}
    owner = np.repeat(np.array([alike.setdefault(s.tobytes(), len(alike)) for s in streams], np.int64), sizes)
    text = np.concatenate(streams) if len(streams) else np.zeros(0, np.int64)
    n = len(text)
    if not n:
        return [np.zeros(k, bool) for k in sizes]
    room = np.concatenate([np.arange(k, 0, -1) for k in sizes])  # tokens to the stream's end
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < run:
        ahead = np.zeros(n, np.int64)
        ahead[:-depth] = rank[depth:] + 1
        ahead[room <= depth] = 0
        rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].astype(np.int64)
        depth *= 2
    suffixes = np.flatnonzero(room >= run)
    suffixes = suffixes[np.lexsort((owner[suffixes], rank[suffixes]))]
    r, o = rank[suffixes], owner[suffixes]
    new_run = np.concatenate([[True], r[1:] != r[:-1]]) if len(r) else np.zeros(0, bool)
    new_owner = new_run | np.concatenate([[True], o[1:] != o[:-1]]) if len(r) else new_run
    begin = np.flatnonzero(new_run)
    owners = np.add.reduceat(new_owner.astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
    often = suffixes[np.repeat(owners >= least, np.diff(np.append(begin, len(r))))]
    edge = np.zeros(n + 1, np.int64)
    edge[often] += 1
    np.add.at(edge, often + run, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.split(covered, np.cumsum(sizes)[:-1])


def _hash(value: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(value, digest_size=8).digest(), "little")


def _word_hashes(ids: dict[str, int]) -> np.ndarray:
    return np.array([_hash(w.encode("utf-8", "surrogatepass")) for w in ids], np.uint64)


def _run_hashes(tokens: np.ndarray) -> np.ndarray:
    """One number for each run of a stream of hashed words."""
    n = max(len(tokens) - RUN + 1, 0)
    found = np.zeros(n, np.uint64)
    for k in range(RUN):
        found = found * _FACTOR + tokens[k : k + n]
    return found.view(np.int64)


def _stream(blocks: list[tuple[int, str]], ids: dict[str, int]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The numbered words and marks outside the article, and where each block's words are among them."""
    tokens: list[int] = []
    spans: list[tuple[int, int]] = []
    for kind, text in blocks:
        if kind == ARTICLE:
            spans.append((0, 0))
            continue
        tokens.append(ids.setdefault("<>", len(ids)))
        begin = len(tokens)
        tokens += [ids.setdefault(w, len(ids)) for w in text.split(" ")]
        spans.append((begin, len(tokens)))
    return np.array(tokens, np.int64), spans


def _covered(streams: list[np.ndarray], ids: dict[str, int], often: np.ndarray) -> list[np.ndarray]:
    """Which tokens of each stream lie in a run whose hash is among ``often``."""
    hashes, found = _word_hashes(ids), []
    for stream in streams:
        edge = np.zeros(len(stream) + 1, np.int64)
        begins = np.flatnonzero(np.isin(_run_hashes(hashes[stream]), often)) if len(stream) else np.zeros(0, np.int64)
        np.add.at(edge, begins, 1)
        np.add.at(edge, begins + RUN, -1)
        found.append(np.cumsum(edge[:-1]) > 0)
    return found


def extract_pages(pages: list[str], often: np.ndarray | None = None) -> list[tuple[str, int]]:
    """Of the pages of one lot: the main text, and how many words outside the article repeat across pages.

    ``often`` has the hashes of the host's repeated runs; without it the pages are all of their host.
    """
    every = [blocks_of(p) for p in pages]
    ids: dict[str, int] = {}
    streams, marks = [], []
    for blocks in every:
        stream, spans = _stream(blocks, ids)
        streams.append(stream)
        marks.append(spans)
    found = []
    masks = repeated(streams) if often is None else _covered(streams, ids, often)
    for blocks, spans, covered in zip(every, marks, masks, strict=True):
        inside = np.concatenate([[0], np.cumsum(covered)])
        kept, words = [], 0
        for (kind, text), (lo, hi) in zip(blocks, spans, strict=True):
            again = int(inside[hi] - inside[lo])
            words += again
            if kind == OPEN and again >= COVERED * (hi - lo):
                text = " ".join(w for w, gone in zip(text.split(" "), covered[lo:hi], strict=True) if not gone)
            if text and kind != DROPPED:
                kept.append(text)
        found.append(("\n".join(kept), words))
    return found


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of pages: of each run of a host every lot that has it, and as many different streams as decide, are given on."""
    names, kinds = ["host", "lot", "run", "stream"], (pa.string(), pa.int32(), pa.int64(), pa.int64())
    for batch in batches:
        hosts: dict[str, list[tuple[int, str]]] = {}
        for host, lot, page in zip(*(batch[c].to_pylist() for c in ("host", "lot", "html")), strict=True):
            hosts.setdefault(host, []).append((lot, page))
        for host, pages in hosts.items():
            ids: dict[str, int] = {}
            streams = [_stream(blocks_of(page), ids)[0] for _, page in pages]
            hashes = _word_hashes(ids)
            parts = [np.unique(_run_hashes(hashes[s])) if len(s) else np.zeros(0, np.int64) for s in streams]
            sizes = [len(part) for part in parts]
            run = np.concatenate(parts)
            lot = np.repeat(np.array([k for k, _ in pages], np.int32), sizes)
            stream = np.repeat(np.array([_hash(hashes[s].tobytes()) for s in streams], np.uint64).view(np.int64), sizes)
            if not len(run):
                continue
            order = np.lexsort((lot, stream, run))
            run, lot, stream = run[order], lot[order], stream[order]
            new_run = np.concatenate([[True], run[1:] != run[:-1]])
            new_stream = new_run | np.concatenate([[True], stream[1:] != stream[:-1]])
            nth = np.cumsum(new_stream)
            nth -= np.repeat(nth[new_run], np.diff(np.append(np.flatnonzero(new_run), len(run))))
            order = np.lexsort((lot, run))
            first = np.ones(len(run), bool)
            first[1:] = (run[order][1:] != run[order][:-1]) | (lot[order][1:] != lot[order][:-1])
            taken = new_stream & (nth < MIN_STREAMS)
            taken[order[first]] = True
            columns = ([host] * int(taken.sum()), lot[taken], run[taken], stream[taken])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def repeated_runs(rows: DataFrame) -> DataFrame:
    """``host``, ``lot``, ``run``: of each lot the runs that enough different streams of the whole host have."""
    runs = rows.select("host", "lot", "html").mapInArrow(_runs, "host string, lot int, run long, stream long")
    found = runs.groupBy("host", "run").agg(F.collect_set("stream").alias("streams"), F.collect_set("lot").alias("lots"))
    return found.filter(F.size("streams") >= MIN_STREAMS).select("host", F.explode("lots").alias("lot"), "run")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by lot, its repeated runs before its pages; a lot's pages are taken together."""
    key, rows, runs, settled = None, [], [], False

    def out() -> pa.RecordBatch:
        found = extract_pages([r[2] for r in rows], np.array(runs, np.int64) if settled else None)
        columns = [[r[0] for r in rows], [r[1] for r in rows], [t for t, _ in found], [len(t) for t, _ in found], [n for _, n in found]]
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "url", "text", "n_chars", "n_repeated"])

    for batch in batches:
        columns = ("host", "lot", "page_id", "url", "html", "many", "run")
        for host, lot, page_id, url, page, many, run in zip(*(batch[c].to_pylist() for c in columns), strict=True):
            if (host, lot) != key:
                if rows:
                    yield out()
                key, rows, runs, settled = (host, lot), [], [], many
            if run is not None:
                runs.append(run)
            else:
                rows.append((page_id, url, page))
    if rows:
        yield out()


def lots(pages: DataFrame, page_text: Column) -> tuple[DataFrame, bool, int]:
    """The rows with ``host``, ``lot`` and ``many``, whether any host has many lots, dealt by a hash of the page, and all bytes."""
    rows = pages.withColumn("host", host_of(F.col("url")))
    sizes = kept(rows.groupBy("host").agg(F.sum(F.octet_length(page_text)).alias("bytes")), "host-sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    large = sizes.filter(F.col("bytes") > LOT_BYTES).select(F.col("host").alias("large"), F.ceil(F.col("bytes") / LOT_BYTES).alias("lots"))
    spread = F.pmod(F.xxhash64("page_id", page_text), F.coalesce("lots", F.lit(1))).cast("int")
    several = not large.isEmpty()
    rows = rows.join(large, F.col("host") == F.col("large"), "left")
    return rows.withColumn("lot", spread).withColumn("many", F.col("large").isNotNull()).drop("large", "lots"), several, total


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``, ``n_repeated``.

    A null or empty page has no text; a null URL has the empty host; rows alike are extracted each, and count as one stream; an
    empty table gives no rows; whole pages of any length are read; more columns do not matter.
    """
    spark = pages.sparkSession
    in_small_batches(spark)
    page = F.coalesce(F.col("html"), F.lit(""))
    rows, several, size = lots(pages.select("page_id", "url", page.alias("html")), F.col("html"))
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    rows = rows.select("host", "lot", "page_id", "url", "html", "many", F.lit(None).cast("long").alias("run"))
    if several:
        runs = repeated_runs(rows.filter("many")).withColumn("many", F.lit(True))
        rows = rows.unionByName(runs, allowMissingColumns=True)
    dealt = rows.repartition(width, "host", "lot").sortWithinPartitions("host", "lot", F.col("run").asc_nulls_last(), "page_id")
    return dealt.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long, n_repeated long")
