"""Path rules and block digests as Column expressions (one row per file)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.protect import digest_hex

# Path separator; smallest digest block (0 means whole range).
SEP = "/"
MIN_BLOCK = 256


def reparent(new_parent: str, old_path: Column) -> Column:
    """``old_path`` placed under ``new_parent``.  An absolute old path (``/``
    or ``\\``) is made relative first by a ``.`` prefix, so it cannot replace
    the new parent: ``reparent('/bak', '/a/b') = '/bak/./a/b'``."""
    rel = F.when(F.substring(old_path, 1, 1).isin("/", "\\"), F.concat(F.lit("."), old_path)).otherwise(old_path)
    if new_parent == "":
        return rel
    if new_parent.endswith(SEP):
        return F.concat(F.lit(new_parent), rel)
    return F.concat(F.lit(new_parent + SEP), rel)


def path_prefixes(path: Column, top_down: bool = True) -> Column:
    """All non-empty prefixes of ``path`` ending at a separator or at its end,
    top-down (``/a``, ``/a/b``, ``/a/b/c``) or bottom-up.  A leading separator
    stays on every prefix; repeated separators count as one."""
    path = F.regexp_replace(path, SEP + "{2,}", SEP)
    parts = F.split(path, SEP, -1)
    absolute = F.substring(path, 1, 1) == SEP
    start = F.when(absolute, F.lit(2)).otherwise(F.lit(1))
    n = F.size(parts)
    idx = F.sequence(start, n)
    prefixes = F.transform(
        idx,
        lambda i: F.concat(F.when(absolute, F.lit(SEP)).otherwise(F.lit("")),
                           F.array_join(F.slice(parts, start, i - start + 1), SEP)),
    )
    prefixes = F.filter(prefixes, lambda p: p != "")
    return prefixes if top_down else F.reverse(prefixes)


def block_digests(content: Column, algo: str = "sha1", block_size: int = 0, offset: int = 0, length: int = 0) -> Column:
    """Digests (hex) of ``content[offset : offset + length]`` per block of
    ``block_size`` bytes, in order; ``length`` 0 means to the end and
    ``block_size`` 0 one digest of the whole range.  Blocks below 256 bytes
    are refused, as by the server-side check this mirrors."""
    if block_size and block_size < MIN_BLOCK:
        raise ValueError(f"block_size must be 0 or at least {MIN_BLOCK}")
    total = F.length(content)
    end = total if length == 0 else F.least(total, F.lit(offset + length))
    span = F.greatest(end - offset, F.lit(0))
    segment = F.substring(content, offset + 1, span)
    if block_size == 0:
        return F.array(digest_hex(segment, algo))
    n_blocks = F.ceil(span / F.lit(block_size)).cast("int")
    idx = F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        idx,
        lambda i: digest_hex(
            F.substring(content, F.lit(offset + 1) + i * block_size, F.least(F.lit(block_size), span - i * block_size)),
            algo,
        ),
    )
