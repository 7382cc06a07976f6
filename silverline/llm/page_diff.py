"""Main text of web pages: nearest-URL differencing of all blocks, checked by markup.

A page is read as blocks of text; scripts, styles and comments are no text. Every
page is paired with the one nearest to it by URL path on the whole host, of those that
mark their article or of those that do not, whose body differs; their blocks are aligned by their longest common subsequence and
shared ones are deleted. Exact and near copies are passed over as partners, as
they share the article. If a host has nothing but pages that are alike, these are
paired among themselves, unless they are equal.

Markup is the check afterwards. Blocks in menus, headers, footers, sidebars,
notices, adverts and forms, known by their element, role, class or id, go even
if no neighbour shares them, since menus and adverts change from page to page.
If the page marks its article (``article``, ``main`` or a role or class that
says so), only that stays, and a line of it that a neighbour shares stays as
well, since articles quote each other, unless every page of the host has it.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import cut
from silverline.llm.host_reputation import host_of, path_of

# Element names by their part in a page.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody td tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template iframe textarea svg math object canvas title xmp noembed noframes".split())
DROPPED_TAGS = frozenset("""nav footer aside form menu dialog head button select option label input search audio video
    map fieldset datalist""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status".split())
# Words in a class or id that tell what is not the article.
DROPPED_WORDS = frozenset("""ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos
    promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer sidebar sidebars rail
    widget widgets related recommended recommendations share sharing social cookie cookies consent gdpr notice notices notification
    alert alerts popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond replies reply
    pagination pager skip search searchform toolbar paywall disclaimer""".split())
MAIN_WORDS = frozenset("""article content maincontent postcontent entrycontent articlebody articlecontent postbody storybody
    entry post story""".split())

RANGE_ROWS = 1 << 15    # pages of one range of the sort at most, about
NOTICE_PAGES = 5        # a host of fewer different pages does not tell its notices

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|</[^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|([^\s=/>"']+)""")
_PARTS = re.compile(r"[^a-z0-9]+")


def _attributes(text: str) -> dict[str, str]:
    return {(m[1] or m[3]).lower(): entities.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(text)}


def _kind(tag: str, attributes: str, in_main: bool) -> str:
    """What an element opens: "drop", "main", "heads" (only its headings stay) or ""."""
    if tag in DROPPED_TAGS:
        return "drop"
    if tag == "header":
        return "heads" if in_main else "drop"
    words: set[str] = set()
    names: list[str] = []
    role = ""
    if attributes and not attributes.isspace():
        found = _attributes(attributes)
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
            return "drop"
        role = found.get("role", "").lower()
        names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
        for name in names:
            words.update(_PARTS.split(name))
    if tag in ("html", "body"):
        return ""
    if role in DROPPED_ROLES:
        return "drop"
    dropped = words & DROPPED_WORDS
    if tag in ("article", "main") or role in ("main", "article"):
        return "drop" if {"comment", "comments", "reply"} & dropped else "main"
    if dropped:
        return "heads" if in_main and dropped == {"header"} else "drop"
    if tag in ("div", "section", "td") and any(_PARTS.sub("", n) in MAIN_WORDS for n in names):
        return "weak"
    return ""


def blocks_of(page: str) -> list[tuple[str, int]]:
    """(text, rank) of the blocks of a page in order; rank 2: inside an article, 1: inside its like, 0: elsewhere, -1: left out by markup."""
    blocks: list[tuple[str, int]] = []
    text: list[str] = []
    lost: list[str] = []
    stack: list[tuple[str, str]] = []          # open elements that matter, with their kind
    dropped = heads = heading = main = weak = 0
    at, n = 0, len(page)

    def end_block():
        for pieces, rank in ((lost, -1), (text, 2 if main else 1 if weak else 0)):
            if pieces:
                joined = " ".join(entities.unescape("".join(pieces)).split())
                pieces.clear()
                if joined:
                    blocks.append((joined, rank))

    def add(piece: str):
        if piece:
            (lost if dropped or heads and not heading else text).append(piece)

    while at < n:
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        add(page[at:token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:                                         # an end tag
            if tag in BLOCK_TAGS:
                end_block()
            if tag in HEADINGS:
                heading = max(0, heading - 1)
            if any(name == tag for name, _ in stack):
                while True:
                    name, kind = stack.pop()
                    dropped -= kind == "drop"
                    heads -= kind == "heads"
                    main -= kind == "main"
                    weak -= kind == "weak"
                    if name == tag:
                        break
            continue
        if tag in RAW_TAGS:                                  # its content is not text
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
            if not token[3].endswith("/") or tag in ("script", "style", "title", "textarea"):
                at = end.end() if end else n
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK_TAGS:
            end_block()
        if tag in VOID_TAGS:
            continue
        if tag in HEADINGS:
            heading += 1
        kind = _kind(tag, token[3], main + weak > 0)
        if kind or any(name == tag and k for name, k in stack):    # inner elements of the same name must be counted
            stack.append((tag, kind))
            dropped += kind == "drop"
            heads += kind == "heads"
            main += kind == "main"
            weak += kind == "weak"
    end_block()
    return blocks


def main_text(page: str) -> tuple[list[str], list[str] | None]:
    """(blocks outside the article, blocks of the article or None if the page marks none)."""
    blocks = [(b, r) for b, r in blocks_of(page) if r >= 0]
    best = max((rank for _, rank in blocks), default=0)
    if best:
        return [b for b, r in blocks if r < best], [b for b, r in blocks if r >= best]
    return [b for b, _ in blocks], None


def common_lines(own: list, other: list) -> set[int]:
    """Positions in ``own`` of a longest common subsequence with ``other`` (Hunt and Szymanski)."""
    at: dict = {}
    for j, line in enumerate(other):
        at.setdefault(line, []).append(j)
    tails: list[int] = []                       # least end in other of a subsequence of each length
    links: list[tuple] = []
    for i, line in enumerate(own):
        for j in reversed(at.get(line, ())):
            k = bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k], links[k] = j, link
    out, link = set(), links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def _hash(line: str) -> int:
    """32 bits: lines are only compared within a host."""
    return int.from_bytes(blake2b(line.encode(), digest_size=4).digest(), "little", signed=True)


_PARSED = "url string, marked boolean, digest binary, form binary, lines array<int>, sizes array<int>, body array<boolean>"
_TEXTS = "page_id long, url string, form binary, packed binary"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(),
             "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_())}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(", "))])


def _batch(columns: list, rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """The given columns, then those of ``rows``."""
    made = zip(*rows, strict=True) if rows else [()] * (len(schema) - len(columns))
    kinds = schema.types[len(columns):]
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(c, t) for c, t in zip(made, kinds, strict=True))], schema=schema)


def _read(page: str | None) -> tuple[bool, list[str], list[int], list[bool], bytes, bytes]:
    """Whether a page marks its article, the blocks of its body, the hashes of all blocks, which are its body, and the digests of the
    body and of all of these (``form``)."""
    found = blocks_of(page or "")
    best = max((rank for _, rank in found), default=0)
    body = [rank >= max(best, 0) for _, rank in found]
    own, lines = [b for (b, _), k in zip(found, body, strict=True) if k], [_hash(b) for b, _ in found]
    digest = blake2b("\0".join(own).encode(), digest_size=16).digest()
    return best > 0, own, lines, body, digest, blake2b(repr((lines, body, best > 0, digest)).encode(), digest_size=16).digest()


def _parse(batches):
    """What tells pages apart, without their text: a row for each url and form of a task."""
    schema, seen = _arrow(_PARSED), set()
    for batch in batches:
        rows = []
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            marked, own, lines, body, digest, form = _read(page)
            if (url, form) not in seen:
                seen.add((url, form))
                rows.append((url, marked, digest, form, lines, [len(b) for b in own], body))
        yield _batch([], rows, schema)


def _pack(batches):
    """The body of each page, packed, as its blocks hold no line break."""
    schema = _arrow(_TEXTS)
    for batch in batches:
        rows = []
        for page in batch.column(2).to_pylist():
            _, own, _, _, _, form = _read(page)
            rows.append((form, zlib.compress("\n".join(own).encode(), 1)))
        yield _batch([batch.column(0), batch.column(1)], rows, schema)


def _unpack(batches):
    """The text of each page without the blocks at the positions ``lost``."""
    schema = _arrow(_OUT)
    for batch in batches:
        rows = []
        for packed, lost in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            blocks, gone = zlib.decompress(packed).decode().split("\n"), frozenset(lost or ())
            text = "\n\n".join([b for i, b in enumerate(blocks) if i not in gone] if gone else blocks)
            rows.append((text, len(text)))
        yield _batch([batch.column(0), batch.column(1)], rows, schema)


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


_OUT = "page_id long, url string, text string, n_chars long"
_KEPT = ("host string, address string, marked boolean, form binary, kept array<int>, kept_lines array<int>, shared array<int>, "
         "lost array<int>, by_difference int, by_markup int")


def _difference(row: dict, partner: list[int] | None) -> dict:
    """Which blocks of a page's body stay and which go, which of its lines the partner has too, and how many blocks went which way."""
    lines, body = row["lines"], row["body"]
    shared = common_lines(lines, partner) if partner is not None else set()
    own = [i for i, b in enumerate(body) if b]
    kept = [k for k, i in enumerate(own) if row["marked"] or i not in shared]
    stays = [own[k] for k in kept]
    gone = set(range(len(lines))).difference(stays)
    return {"host": row["host"], "address": row["address"], "marked": row["marked"], "form": row["form"], "kept": kept,
            "kept_lines": [lines[i] for i in stays], "shared": sorted({lines[i] for i in stays if i in shared}),
            "lost": sorted(set(range(len(own))).difference(kept)), "by_difference": len(gone & shared), "by_markup": len(gone - shared)}


def _alike(a: dict, b: dict) -> bool:
    """Exact or near copies: over two thirds of the blocks and of the characters of the longer one are in both.

    Both counts are asked: menus are many short blocks, notices few long ones, and
    pages that share these alone are no copies.
    """
    if a["digest"] == b["digest"]:
        return True
    most, longest = max(len(a["hashes"]), len(b["hashes"])), max(sum(a["sizes"]), sum(b["sizes"]))
    if 3 * min(len(a["hashes"]), len(b["hashes"])) <= 2 * most or 3 * min(sum(a["sizes"]), sum(b["sizes"])) <= 2 * longest:
        return False
    left = Counter(b["hashes"])
    shared = chars = 0
    for line, size in zip(a["hashes"], a["sizes"], strict=True):
        if left[line] > 0:
            left[line] -= 1
            shared += 1
            chars += size
    return 3 * shared > 2 * most and 3 * chars > 2 * longest


def _site(row: dict) -> tuple[str, bool]:
    """Pages that mark their article are paired among themselves."""
    return row["host"], row["marked"]


def _body(row: dict) -> tuple[str, bytes]:
    return row["address"], row["digest"]


def _runs(rows: list[dict]) -> list[tuple[int, int]]:
    """(start, end) of the runs of rows that lie on one host and are copies of their first."""
    starts: list[int] = []
    for i, row in enumerate(rows):
        if not starts or _site(row) != _site(rows[starts[-1]]) or not _alike(rows[starts[-1]], row):
            starts.append(i)
    return list(zip(starts, [*starts[1:], len(rows)], strict=True))


_ORDER = ("host", "marked", "path", "address", "digest", "form")
_SLIM = ("host string, marked boolean, path string, address string, digest binary, form binary, lines array<int>, sizes array<int>, "
         "body array<boolean>, part int")
_SETTLED = f"{_SLIM}, role string, " + ", ".join(_KEPT.split(", ")[4:])


def _in_order(rows: list[dict]) -> list[dict]:
    """Rows sorted, equal ones once, with the hashes of their body."""
    out: list[dict] = []
    last = None
    for row in sorted(rows, key=lambda r: tuple(r[k] for k in _ORDER)):
        if (key := tuple(row[k] for k in _ORDER)) != last:
            last = key
            out.append({**row, "hashes": [x for x, b in zip(row["lines"], row["body"], strict=True) if b]})
    return out


def _partners(run: list[dict], before: dict | None, after: dict | None, next_before: dict | None, next_after: dict | None):
    """Each row of a run with the lines of its partner, or None.

    ``before`` and ``after`` are the rows next to the run, ``next_before`` and ``next_after`` those next to the part of it that is
    given, copies or not.
    """
    following: list[dict | None] = [next_after] * len(run)
    for i in range(len(run) - 2, -1, -1):
        following[i] = run[i + 1] if _body(run[i + 1]) != _body(run[i]) else following[i + 1]
    previous = next_before
    for i, row in enumerate(run):
        if i and _body(run[i - 1]) != _body(row):
            previous = run[i - 1]
        near = [r for r in (before, after) if r is not None and _site(r) == _site(row) and not _alike(r, row)]
        if not near:
            near = [r for r in (previous, following[i]) if r is not None and _site(r) == _site(row) and r["digest"] != row["digest"]]
        # the one before if both are as near
        yield row, max(near, key=lambda r: _shared_prefix(row["path"], r["path"]))["lines"] if near else None


def _settle(batches):
    """Differences the pages of a range, all but its first and last run, which other ranges may go on with: their rows have the role
    ``head``, ``tail`` or, if the range is one run, ``only``.

    Other roles are what other ranges need: first and last of the outer runs, the rows next to these runs on their host, and the
    rows nearest to the ends that are not of one address and body with them.
    """
    schema = _arrow(_SETTLED)
    rows = _in_order([row for batch in batches for row in batch.to_pylist()])
    if not rows:
        return
    runs = _runs(rows)
    (_, second), (leader, end) = runs[0], runs[-1]
    found = {"first": 0, "leader": leader, "last": end - 1}
    if len(runs) > 1:
        if _site(rows[second]) == _site(rows[0]):
            found["second"] = second
        if _site(rows[leader - 1]) == _site(rows[leader]):
            found["prior"] = leader - 1
    for place, ends, steps in (("other_first", rows[0], range(len(rows))), ("other_last", rows[-1], range(end - 1, -1, -1))):
        if (other := next((i for i in steps if _body(rows[i]) != _body(ends)), None)) is not None:
            found[place] = other
    edges = [{**rows[i], "role": place} for place, i in found.items()]
    outer = {"only": (0, end)} if len(runs) == 1 else {"head": (0, second), "tail": (leader, end)}
    left = [{**row, "role": role} for role, (start, stop) in outer.items() for row in rows[start:stop]]
    settled = [_difference(row, partner) for start, stop in runs[1:-1]
               for row, partner in _partners(rows[start:stop], rows[start - 1], rows[stop], rows[start - 1], rows[stop])]
    yield from pa.Table.from_pylist([*edges, *left, *settled], schema=schema).to_batches(max_chunksize=10_000)


def _carried(ranges: list[dict]) -> list[dict[str, tuple[dict | None, ...]]]:
    """For each range in order what ``_partners`` asks for the rows of each role: the row before the run and the row after it, on the
    host and no copy of the run; then the rows next to it, whatever they are, but for those of the same address and body."""
    def seek(own: dict, others, outer: str, head: str, inner: str) -> dict | None:
        for other in others:
            if _site(other[head]) != _site(own):
                return None
            if not _alike(other[head], own):
                return other[outer]
            if inner in other:                 # the run goes on there and ends within
                return other[inner]
            if _site(other["first"]) != _site(other["last"]):
                return None
        return None

    def beside(own: dict, others, outer: str, inner: str) -> dict | None:
        for other in others:
            if _body(other[outer]) != _body(own):
                return other[outer]
            if inner in other:
                return other[inner]
        return None

    out = []
    for i, r in enumerate(ranges):
        before = seek(r["first"], reversed(ranges[:i]), "last", "leader", "prior")
        after = seek(r["leader"], ranges[i + 1:], "first", "first", "second")
        next_before = beside(r["first"], reversed(ranges[:i]), "last", "other_last")
        next_after = beside(r["last"], ranges[i + 1:], "first", "other_first")
        out.append({"head": (before, r.get("second"), next_before, r.get("second")), "tail": (r.get("prior"), after, r.get("prior"), next_after),
                    "only": (before, after, next_before, next_after)})
    return out


def read_blocks(pages: DataFrame) -> DataFrame:
    """The parsed pages (``_PARSED``, no text) with address and host, written once."""
    parsed = cut(pages.select("url", "html").mapInArrow(_parse, _PARSED), "page-blocks")
    return parsed.withColumns({"address": F.coalesce("url", F.lit("")), "host": host_of(F.col("url"))})


def decide(parsed: DataFrame) -> DataFrame:
    """A row for each page with blocks, known by address and form: host, kept and lost (positions in the body), kept_lines (hashes of
    the kept), shared (lines that stay and the partner has), and how many blocks went by differencing and how many by markup alone.

    A page's partner is the nearest in path order on the host that differs; on a host whose pages are all alike it is the next page
    that is not equal. Rows are sorted by range over all hosts, so no task holds a host, and differenced where they lie. The edges
    of ranges go by the driver (seven rows a range at most), so a neighbour in another range, or beyond ranges full of copies, is found
    too; only the outer runs of ranges move again. No text moves.
    """
    slim = parsed.filter(F.size("lines") > 0).select("host", "marked", path_of(F.col("url")).alias("path"), "address", "digest", "form",
                                                     "lines", "sizes", "body")
    ranges = max(int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-slim.count() // RANGE_ROWS))
    ranged = cut(slim.repartitionByRange(ranges, *_ORDER).withColumn("part", F.spark_partition_id()).mapInArrow(_settle, _SETTLED), "page-order")
    left = F.col("role").isin("head", "tail", "only")
    edges: dict[int, dict] = defaultdict(dict)
    for row in ranged.filter(~left).collect():
        found = row.asDict() | {"digest": bytes(row["digest"])}
        edges[row["part"]][row["role"]] = found | {"hashes": [x for x, b in zip(row["lines"], row["body"], strict=True) if b]}
    parts = sorted(edges)
    carried = dict(zip(parts, _carried([edges[p] for p in parts]), strict=True))

    def rest(group: pa.Table) -> pa.Table:
        rows = _in_order(group.to_pylist())
        found = _partners(rows, *carried[rows[0]["part"]][rows[0]["role"]])
        return pa.Table.from_pylist([_difference(row, partner) for row, partner in found], schema=_arrow(_KEPT))

    names = _arrow(_KEPT).names
    outer = cut(ranged.filter(left).groupBy("part", "role").applyInArrow(rest, _KEPT), "page-kept")
    return ranged.filter("role IS NULL").select(names).unionByName(outer)


def notices(kept: DataFrame) -> DataFrame:
    """(host, notices): hashes of the lines that stand in the article of every page of a host of NOTICE_PAGES or more.

    Only lines that some page shares with its partner are counted. Pages with equal articles are one page.
    """
    some = kept.filter(F.size("shared") > 0).select("host").distinct()
    told = kept.filter(F.size("kept_lines") > 0).join(some, "host", "left_semi") \
        .select("host", "kept_lines", F.hash("kept_lines").alias("a"), F.xxhash64("kept_lines").alias("b")) \
        .dropDuplicates(["host", "a", "b"])
    pages = told.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= NOTICE_PAGES)
    asked = kept.select("host", F.explode("shared").alias("line")).distinct().join(pages, "host")
    held = told.select("host", F.explode(F.array_distinct("kept_lines")).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    return held.join(asked, ["host", "line"]).filter("n = pages") \
        .groupBy("host").agg(F.collect_list("line").alias("notices"))        # all on every page: no more than a page has


def losses(kept: DataFrame) -> DataFrame:
    """(address, form, lost): positions of the blocks that leave a body, by differencing or as notices, of the pages that lose any."""
    every = cut(notices(kept), "page-notices")
    noticed = F.filter(F.arrays_zip("kept", "kept_lines"), lambda b: F.array_contains(F.col("notices"), b["kept_lines"]))["kept"]
    return kept.join(every, "host", "left").withColumn("lost", F.concat("lost", noticed)) \
        .filter(F.size("lost") > 0).select("address", "form", "lost")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    White space inside a block becomes one space, blocks are joined by an empty
    line. Null, empty or textless html has the empty text. A page that marks no
    article and has no page on its host that differs from it keeps all blocks that
    are not left out by their markup; so repeated rows, which each stay, and equal
    pages lose nothing to each other. No other columns are read.

    Pages are parsed twice: what is decided between is written without their text.
    It comes back as the blocks to leave out, of the pages that lose any, so texts
    only move, packed, if these are too many to be sent to every task.
    """
    lost = cut(losses(decide(read_blocks(pages))), "page-lost")
    packed = pages.select("page_id", "url", "html").mapInArrow(_pack, _TEXTS).withColumn("address", F.coalesce("url", F.lit("")))
    return packed.join(lost, ["address", "form"], "left").select("page_id", "url", "packed", "lost").mapInArrow(_unpack, _OUT)
