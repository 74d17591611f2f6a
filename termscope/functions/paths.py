"""Path-derived columns: file name, folder, type, index number, routing, kind.

All are plain Catalyst expressions, so they stay inside whole-stage codegen and
can be pushed next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def plain_path(metadata_path: Column | str) -> Column:
    """The one form in which every reader gives a path: the (URL-encoded)
    ``_metadata.file_path`` decoded, local paths without their scheme, so that
    inventory, segments and reports join."""
    decoded = F.url_decode(F.replace(_c(metadata_path), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def file_name(path: Column | str) -> Column:
    """Last path component."""
    return F.element_at(F.split(_c(path), "/"), -1)


def folder(path: Column | str) -> Column:
    """Text before the file name, trailing separator kept (cut at the last
    component, not at the first occurrence of the name)."""
    p = _c(path)
    return p.substr(F.lit(1), F.length(p) - F.length(file_name(p)))


def file_type(path: Column | str) -> Column:
    """Text after the last dot, case kept; the whole path when there is no dot."""
    return F.substring_index(_c(path), ".", -1)


# Characters that mark a first token as "not an index" in the
# older index-number rules.
SPECIAL_CHARS = r"[@_!#$%^&*()<>?/|}{~:]"


def _lone_dot_to_space(s: Column) -> Column:
    return F.when(F.length(s) == 1, F.regexp_replace(s, r"\.", " ")).otherwise(s)


def _single_case(s: Column) -> Column:
    """Python ``isupper() or islower()``: has cased letters, all of one case."""
    cased = F.upper(s) != F.lower(s)
    return cased & ((s == F.upper(s)) | (s == F.lower(s)))


def index_number(name: Column | str, variant: str = "latest") -> Column:
    """P4 and its older variants.

    * ``latest`` (P4): leading run of ``[0-9._]``, cut at the first ``_``, a lone
      ``.`` becomes a space. After the cut only digits and dots remain, so this
      is the leading ``[0-9.]*`` run.
    * ``token_test`` (P4b): first space-separated token; single-case or
      special-character tokens give ``' '``; else keep digits, dots, spaces.
    * ``cut_then_test`` (P4b'): as ``token_test`` but the token is cut at ``_``
      before the test.
    * ``token_cut`` (P4c): first token, cut at ``_``, keep digits/dots/spaces,
      lone ``.`` to space. ``token_cut_keep_dot`` drops the lone-dot rule.
    * ``token`` (P4d): first token unchanged.
    """
    n = _c(name)
    first = F.element_at(F.split(n, " "), 1)
    cut = F.element_at(F.split(first, "_"), 1)
    keep = lambda s: F.regexp_replace(s, r"[^0-9.\s]+", "")
    if variant == "latest":
        return _lone_dot_to_space(F.regexp_extract(n, r"^[0-9.]*", 0))
    if variant == "token_test":
        bad = _single_case(first) | first.rlike(SPECIAL_CHARS)
        return F.when(bad, F.lit(" ")).otherwise(_lone_dot_to_space(keep(cut)))
    if variant == "cut_then_test":
        bad = _single_case(cut) | cut.rlike(SPECIAL_CHARS)
        return F.when(bad, F.lit(" ")).otherwise(_lone_dot_to_space(keep(cut)))
    if variant == "token_cut":
        return _lone_dot_to_space(keep(cut))
    if variant == "token_cut_keep_dot":
        return keep(cut)
    if variant == "token":
        return first
    raise ValueError(f"unknown index-number variant {variant!r}")


def strip_root(path: Column | str, root: str) -> Column:
    """P5: drop a literal run-root prefix (kept unchanged when absent)."""
    p = _c(path)
    return F.when(p.startswith(root), p.substr(len(root) + 1, 1 << 30)).otherwise(p)


# Extension routing of the deployed generation, in its order.
# Matching is a case-sensitive "ends with"; "ppt" and "XLSX" carry no dot.
HANDLER_SUFFIXES: list[tuple[str, tuple[str, ...]]] = [
    ("csv", (".csv",)),
    ("xlsb", (".xlsb",)),
    ("msg", (".msg",)),
    ("txt", (".txt",)),
    ("rtf", (".rtf",)),
    ("docx", (".docx", ".DOCX")),
    ("doc", (".doc", ".DOC")),
    ("odt", (".odt",)),
    ("ppt", (".pptx", "ppt", ".PPTX", ".PPT")),
    ("image", (".PNG", ".png", ".JPEG", ".jpeg", ".JPG", ".jpg", ".gif", ".pnm", ".PNM")),
    ("xlsx", (".xlsx", ".xlsm", ".xls", ".XLS", "XLSX")),
    ("pdf", (".pdf", ".PDF")),
    ("tiff", (".tiff", ".tif", ".jfif", ".bmp")),
]

UNKNOWN = "Unknown"


def handler(path: Column | str, case_sensitive: bool = True) -> Column:
    """Which scan handles a file, by suffix; ``unknown`` otherwise.

    Every listed suffix but ``ppt`` and ``XLSX`` starts with a dot, so "ends
    with" is a lookup of the text after the last dot in a literal map; the two
    dot-less suffixes are checked after it. The path is referenced three
    times only, so the expression stays small when Catalyst inlines a
    computed path into a pushed-down filter."""
    p = _c(path)
    ext = F.substring_index(p, ".", -1)
    if not case_sensitive:
        p, ext = F.lower(p), F.lower(ext)
    entries: dict[str, str] = {}
    bare: list[tuple[str, str]] = []
    for name, suffixes in HANDLER_SUFFIXES:
        for s in suffixes:
            s2 = s if case_sensitive else s.lower()
            if s2.startswith("."):
                entries.setdefault(s2[1:], name)
            else:
                bare.append((s2, name))
    lookup = F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), F.lit(v))])
    fallback = None
    for s2, name in bare:
        cond = p.endswith(s2)
        fallback = F.when(cond, F.lit(name)) if fallback is None else fallback.when(cond, F.lit(name))
    return F.coalesce(lookup[ext], fallback, F.lit("unknown"))


# Kind labels of the scope index and the suffixes that select them.
KIND_SUFFIXES: list[tuple[str, tuple[str, ...]]] = [
    ("Microsoft Excel", (".xlsx",)),
    ("Microsoft Word", (".doc", ".docx", ".DOCX")),
    ("Text File", (".txt",)),
    ("Image", (".jpg", ".png", ".bmp", ".pnm", ".jfif", ".jpeg", ".tiff")),
    ("Microsoft Powerpoint", (".pptx", ".ppt")),
    ("Adobe PDF", (".pdf",)),
]


def kind(name: Column | str) -> Column:
    """Scope-index kind of a file name (folders are labelled by the caller)."""
    n = _c(name)
    ext = F.substring_index(n, ".", -1)
    lookup = F.create_map(*[x for label, suffixes in KIND_SUFFIXES for sfx in suffixes for x in (F.lit(sfx[1:]), F.lit(label))])
    return F.coalesce(F.when(F.contains(n, F.lit(".")), lookup[ext]), F.lit(UNKNOWN))


def second_last_component(path: Column | str) -> Column:
    """P20 helper: the component before the last one."""
    return F.try_element_at(F.split(F.regexp_replace(_c(path), "/+$", ""), "/"), F.lit(-2))


def path_id_matches(root: Column | str, request_root: Column | str, guid: Column | str) -> Column:
    """P20: both run roots belong to the user: the component before the last
    one of each root is the GUID (strings are literal values; callers check it
    with ``assert_true``)."""
    root, request_root, guid = (F.lit(x) if isinstance(x, str) else x for x in (root, request_root, guid))
    return (second_last_component(root) == guid) & (second_last_component(request_root) == guid)


def with_path_parts(df, path_col: str = "path", index_variant: str = "latest"):
    """Add ``file_name, folder, file_type, index_number`` next to ``path``."""
    p = F.col(path_col)
    return (df.withColumn("file_name", file_name(p))
              .withColumn("folder", folder(p))
              .withColumn("file_type", file_type(p))
              .withColumn("index_number", index_number(F.col("file_name"), index_variant)))
