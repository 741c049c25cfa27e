"""String expressions: sample ids, alleles, FORMAT / INFO fields, barcodes, display text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name suffixes of per-sample variant files, longest first.
BURDEN_SUFFIXES = [
    ".filtered.annotated.vcf.gz",
    ".filtered.annotated.vcf",
    ".filtered.vcf.gz",
    ".filtered.vcf",
    ".raw.vcf.gz",
    ".raw.vcf",
    ".vcf.gz",
    ".vcf",
]
INTEGRATION_SUFFIXES = [
    ".filtered.annotated.vcf.gz",
    ".filtered.annotated.vcf",
    ".filtered.with_filters.vcf.gz",
    ".filtered.with_filters.vcf",
    ".filtered.vcf.gz",
    ".filtered.vcf",
    ".raw.vcf.gz",
    ".raw.vcf",
    ".vcf.gz",
    ".vcf",
    ".bam",
]
# Fixed value: marker the aligner leaves in file names.
ALIGNER_MARK = "Aligned.sortedByCoord.out"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def normalize_sample_id(name: Column, suffixes: Sequence[str] = INTEGRATION_SUFFIXES) -> Column:
    """Drop the first of the listed suffixes that fits, then every aligner mark."""

    def shorten(n):
        cut = [F.when(F.endswith(n, F.lit(s)), F.substring(n, F.lit(1), F.length(n) - len(s))) for s in suffixes]
        return F.coalesce(*cut, n)

    return F.replace(let(name, shorten), F.lit(ALIGNER_MARK), F.lit(""))


def first_alt(alt: Column) -> Column:
    return F.substring_index(alt, ",", 1)


def variant_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """Text key for sinks; joins use the four columns."""
    return F.concat_ws(":", chrom, pos.cast("string"), ref, first_alt(alt))


def format_value(fmt: Column, sample: Column, key: str) -> Column:
    """Value of a FORMAT key in a sample column; the last of repeated keys, NULL when absent."""

    def pick(keys, values, n):
        from_end = F.array_position(F.reverse(F.slice(keys, F.lit(1), n)), key)
        return let(from_end, lambda p: F.when(p > 0, F.get(values, (n - p).cast("int"))))

    return let(
        F.split(fmt, ":"),
        lambda keys: let(
            F.split(sample, ":"),
            lambda values: let(F.least(F.size(keys), F.size(values)), lambda n: pick(keys, values, n)),
        ),
    )


def info_value(info: Column, key: str) -> Column:
    """Value of ``key=value`` in an INFO column; the last of repeated keys, NULL when absent."""
    mark, padded = f";{key}=", F.concat(F.lit(";"), info)
    return F.when(
        F.contains(padded, F.lit(mark)), F.substring_index(F.substring_index(padded, mark, -1), ";", 1)
    )


def _number(text: Column) -> Column:
    return text.try_cast("double")


def allele_fraction(fmt: Column, sample: Column, missing_af: float = 1.0) -> Column:
    """AF of a call: its AF field, else alternate share of AD, else ``missing_af``.

    Unreadable numbers fall through to the next rule; an AF of NaN becomes NULL.
    """
    stated = _number(F.substring_index(format_value(fmt, sample, "AF"), ",", 1))

    def share(depths):
        ref_n, alt_n = _number(F.get(depths, F.lit(0))), _number(F.get(depths, F.lit(1)))
        total = ref_n + alt_n
        return F.when((total > 0) & ~F.isnan(total), alt_n / total).otherwise(F.lit(missing_af))

    def choose(af):
        from_depths = let(F.split(format_value(fmt, sample, "AD"), ","), share)
        return F.when(af.isNotNull(), F.when(~F.isnan(af), af)).otherwise(from_depths)

    return let(stated, choose)


def fixed_text(value: Column, digits: int) -> Column:
    """Decimal text with ``digits`` places, ties to even."""
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def mean_sd_text(mean: Column, sd: Column) -> Column:
    """``m +/- s`` with three places; only the mean when there is no deviation."""
    return F.when(sd.isNull(), fixed_text(mean, 3)).otherwise(
        F.concat(fixed_text(mean, 3), F.lit(" +/- "), fixed_text(sd, 3))
    )


def cohort_info(info: Column, count: Column, max_af: Column) -> Column:
    """INFO text with the cohort count and maximal fraction appended."""
    kept = F.when(~info.isin(".", ""), info)
    return F.concat_ws(
        ";",
        kept,
        F.concat(F.lit("COHORT_COUNT="), count.cast("string")),
        F.concat(F.lit("MAX_AF="), fixed_text(max_af, 6)),
    )


def barcode_core(cell_id: Column) -> Column:
    """First run of 16 or more bases, else the text before the first ``-`` and ``_``."""
    run = F.regexp_substr(cell_id, F.lit("[ACGT]{16,}"))
    return F.coalesce(run, F.substring_index(F.substring_index(cell_id, "-", 1), "_", 1))


def variant_class(ref: Column, alt1: Column) -> Column:
    """``snv`` for one-base to one-base changes, ``indel`` for everything else."""
    return F.when((F.length(ref) == 1) & (F.length(alt1) == 1), "snv").otherwise("indel")


def strict_variant_class(ref: Column, alt1: Column) -> Column:
    """Like ``variant_class`` with multi-base changes and symbolic alleles kept apart."""
    bases = "^[ACGTN]+$"
    return (
        F.when(~ref.rlike(bases) | ~alt1.rlike(bases), "symbolic")
        .when((F.length(ref) == 1) & (F.length(alt1) == 1), "snv")
        .when(F.length(ref) == F.length(alt1), "mnv")
        .otherwise("indel")
    )


def substitution_channel(ref: Column, alt1: Column) -> Column:
    return F.concat(ref, F.lit(">"), alt1)


def natural_sort_key(name: Column) -> list[Column]:
    """Order by the letters, then the numbers, then the text."""
    numbers = F.transform(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), lambda d: d.cast("decimal(38,0)"))
    numbers = F.when(F.size(numbers) == 0, F.array(F.lit(0).cast("decimal(38,0)"))).otherwise(numbers)
    return [F.regexp_replace(name, r"\d+", ""), numbers, name]


def natural_sort_text(name: Column) -> Column:
    """One text per name that sorts bytewise as :func:`natural_sort_key`, which is far slower to compare.

    Letters as hexadecimal digits, numbers padded to 38 digits; a blank, below all of these, ends either.
    """
    letters, numbers, _ = natural_sort_key(name)
    padded = F.transform(numbers, lambda d: F.coalesce(F.lpad(d.cast("string"), 38, "0"), F.lit("!" * 38)))
    return F.concat(F.hex(F.encode(letters, "UTF-8")), F.lit(" "), F.array_join(padded, ""), F.lit(" "), name)


def file_kind(path: Column) -> Column:
    """Report class of a file by its suffix."""
    # Suffixes of the three report classes.
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    return (
        F.when(suffix.isin(".png", ".jpg", ".jpeg", ".svg", ".pdf"), "figure")
        .when(suffix.isin(".tsv", ".csv", ".xlsx", ".xls"), "table")
        .when(suffix.isin(".md", ".txt"), "report")
        .otherwise("other")
    )


# English month names as the tools print them, by their first letters.
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def log_time(text: Column) -> Column:
    """Time stamp of a printed date; NULL when there is none.

    The parts are looked for on their own, so order, commas, weekday and zone names do not
    matter: a clock, AM or PM beside it, and either an ISO date or a month name with a day
    and a year.
    """

    def number(pattern: str) -> Column:
        return F.regexp_extract(text, pattern, 1).try_cast("int")

    clock = r"\b(\d{1,2}):\d{2}:\d{2}\b", r"\b\d{1,2}:(\d{2}):\d{2}\b", r"\b\d{1,2}:\d{2}:(\d{2})\b"
    hour, minute, second = map(number, clock)
    half = F.upper(F.regexp_extract(text, r"(?i)\d\W?([AP])M\b", 1))
    hour = F.when(half == "", hour).otherwise(hour % 12 + F.when(half == "P", 12).otherwise(0))
    names = "|".join(MONTHS[i : i + 3] for i in range(0, len(MONTHS), 3))
    name = F.regexp_extract(text, rf"\b({names})[a-z]*\W+\d", 1)
    month = F.when(name != "", (F.instr(F.lit(MONTHS), name) + 2) / 3).cast("int")
    day = number(rf"\b(?:{names})[a-z]*\W+(\d{{1,2}})\b")
    year = number(r"(?<![:\d])(\d{4})(?![:\d])")
    iso = [number(p) for p in (r"\b(\d{4})-\d{2}-\d{2}\b", r"\b\d{4}-(\d{2})-\d{2}\b", r"\b\d{4}-\d{2}-(\d{2})\b")]
    parts = [F.coalesce(i, p) for i, p in zip(iso, (year, month, day))]
    return F.try_make_timestamp(*parts, hour, minute, second.cast("decimal(8,6)"))


def minutes_text(minutes: Column) -> Column:
    """Duration text: one decimal under a minute, whole minutes under 90, else hours."""
    m = F.greatest(F.lit(0.0), minutes.cast("double"))
    whole = F.bround(m).cast("long")
    hours = F.floor(m / 60)
    rest = F.bround(m - hours * 60).cast("long")
    carry = (rest == 60).cast("long")
    return (
        F.when(minutes.isNull(), F.lit(""))
        .when(m < 1, F.concat(fixed_text(m, 1), F.lit(" min")))
        .when(m < 90, F.concat(whole.cast("string"), F.lit(" min")))
        .otherwise(
            F.concat((hours + carry).cast("string"), F.lit(" h "), (rest - 60 * carry).cast("string"), F.lit(" min"))
        )
    )


def signed_minutes_text(minutes: Column) -> Column:
    sign = F.when(minutes >= 0, "+").otherwise("-")
    return F.when(minutes.isNull(), F.lit("")).otherwise(F.concat(sign, minutes_text(F.abs(minutes))))
