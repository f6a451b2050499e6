"""What the two reports must say, counted in plain Python over collected rows."""

from collections import Counter


def _share(valid, total):
    # Half up at the second decimal, as the reports round.
    return int(valid * 10_000 / total + 0.5) / 100 if total else 0.0


def _named(share, sound):
    if sound:
        return "SUCCESS"
    return next((name for least, name in ((99, "WARNING"), (95, "ERROR")) if share >= least), "CRITICAL")


def quality_of(rows, columns, key):
    """The quality report of ``rows``, tuples in the order of ``columns``."""
    keys = Counter(tuple(row[columns.index(k)] for k in key) for row in rows)
    broken = {row for row in rows if None in row}
    share = _share(len(rows) - len(broken), len(rows))
    repeated = sum(n > 1 for n in keys.values())
    return {
        "records": len(rows),
        "valid_records": len(rows) - len(broken),
        "null_records": len(broken),
        "duplicates": repeated,
        "quality": share,
        "status": _named(share, not broken and not repeated),
        "columns_with_null": sum(None in column for column in zip(*rows, strict=True)),
        "invalid_row_total": sum(None in row for row in rows),
    }


def rules_of(pairs):
    """The rule report of ``(key, measure)`` pairs."""
    facts = Counter()
    for key, measure in pairs:
        no_key = not (key or "").strip(" ")
        facts["null_keys"] += no_key
        facts["negative_totals"] += measure is not None and measure < 0
        facts["zero_totals"] += measure == 0
        facts["invalid_records"] += no_key or (measure is not None and measure <= 0)
    repeated = sum(n > 1 for n in Counter(key for key, _ in pairs).values())
    share = _share(len(pairs) - facts["invalid_records"], len(pairs))
    names = ("null_keys", "negative_totals", "zero_totals", "invalid_records")
    return {
        "total": len(pairs),
        "duplicate_keys": repeated,
        **{name: facts[name] for name in names},
        "quality": share,
        "status": _named(share, not facts["invalid_records"] and not repeated),
    }
