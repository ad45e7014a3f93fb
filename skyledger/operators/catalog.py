"""File catalogue: validation, priorities, routes, names and sizes. All are projections, with one join for metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import basename, bucket_of, extension, is_mode, number_list, slot_of, stem
from .order import running

#: File type codes.
HW_LFILES, FLAG, PPD, VOLTAGES, VISIBILITIES, VDIF, FILTERBANK = 8, 10, 14, 17, 18, 19, 20
#: Stem lengths allowed for each type.
STEM_LENGTHS = {VOLTAGES: (23, 24, 25), VISIBILITIES: (35,), PPD: (24, 19, 10), FLAG: (16,), VDIF: (23, 34), FILTERBANK: (23, 34)}
#: Codes of the archive locations that have buckets.
LOCATIONS = (2, 3, 4)


def validate_files(listing: DataFrame, observations: DataFrame) -> DataFrame:
    """Adds ``obs_id, filetype_id, file_ext, project_id, calibrator, valid, message`` to a listing with ``path``.

    The first check that fails sets the message: the first ten characters are the observation id, the
    extension is known, the stem has a length of its type, the observation is known. A
    calibrator whose source is the Sun doesn't count as one. ``observations``: ``obs_id,
    project_id, calibrator, calibrator_source``, one row for each id.
    """
    name, ext, rest = basename(F.col("path")), extension(F.col("path")), F.substring(stem(F.col("path")), 11, 200)
    kind = (
        F.when(ext == ".sub", VOLTAGES)
        .when(ext == ".fits", F.when(rest.isin("_metafits_ppds", "_metafits"), PPD).otherwise(VISIBILITIES))
        .when(ext == ".metafits", PPD).when(ext == ".zip", FLAG).when(ext.isin(".vdif", ".hdr"), VDIF).when(ext == ".fil", FILTERBANK)
    )
    rows = listing.select("*", F.regexp_extract(name, r"^([0-9]{10})", 1).try_cast("bigint").alias("obs_id"), ext.alias("file_ext"), F.length(stem(F.col("path"))).alias("_len"))
    rows = rows.withColumn("filetype_id", F.when(F.col("obs_id").isNotNull(), kind).cast("int"))
    fits = F.lit(False)
    for t, lengths in STEM_LENGTHS.items():
        fits = fits | ((F.col("filetype_id") == t) & F.col("_len").isin(*lengths))
    meta = observations.select("obs_id", "project_id", (F.col("calibrator") & ~F.upper(F.coalesce("calibrator_source", F.lit(""))).eqNullSafe("SUN")).alias("calibrator"), F.lit(True).alias("_known"))
    rows = rows.join(meta, "obs_id", "left")
    message = (
        F.when(F.col("obs_id").isNull(), "name does not begin with an observation id")
        .when(F.col("filetype_id").isNull(), "unknown extension")
        .when(~fits, "name has a wrong length for its type")
        .when(F.col("_known").isNull(), "observation not found")
        .otherwise("")
    )
    return rows.withColumn("message", message).withColumn("valid", F.col("message") == "").drop("_len", "_known")


def with_priority(files: DataFrame, corr_high: list[str], vcs_high: list[str]) -> DataFrame:
    """Adds ``priority``: 1 is most urgent. Null for files that aren't valid."""
    t, project = F.col("filetype_id"), F.col("project_id")
    priority = (
        F.when(~F.col("valid"), None)
        .when(t == PPD, 1)
        .when(t == VISIBILITIES, F.when(F.col("calibrator"), 2).when(project.isin(corr_high), 3).otherwise(30))
        .when(t.isin(VDIF, FILTERBANK), F.when(project.isin(vcs_high), 5).otherwise(10))
        .when(t == VOLTAGES, F.when(project.isin(vcs_high), 20).otherwise(90))
        .otherwise(100)
    )
    return files.withColumn("priority", priority.cast("int"))


def is_archivable(project: Column) -> Column:
    return F.upper(project) != "C123"


def route_ingest(files: DataFrame, archiving_enabled: bool) -> DataFrame:
    """Adds ``route`` after the checksum: visibilities to their statistics, others out or kept from the archive."""
    t = F.col("filetype_id")
    out = F.when(is_archivable(F.col("project_id")) & F.lit(archiving_enabled), "outgoing").otherwise("dont_archive")
    return files.withColumn("route", F.when(t == VISIBILITIES, "processing_stats").when(t.isin(VOLTAGES, PPD, VDIF, FILTERBANK), out))


def route_visibility(files: DataFrame, archiving_enabled: bool) -> DataFrame:
    """Adds ``stats_selected`` and ``route`` after statistics."""
    keep = is_archivable(F.col("project_id")) & F.lit(archiving_enabled)
    route = F.when(~F.coalesce(keep, F.lit(False)), "dont_archive").when(F.col("calibrator"), "outgoing_cal").otherwise("outgoing")
    return files.withColumn("stats_selected", basename(F.col("path")).endswith("_000.fits")).withColumn("route", route)


def release_cal(files: DataFrame, release: DataFrame, archiving_enabled: bool) -> DataFrame:
    """Files of the observations in ``release``, with their route."""
    route = F.when(is_archivable(F.col("project_id")) & F.lit(archiving_enabled), "outgoing").otherwise("dont_archive")
    return files.join(release.select("obs_id"), "obs_id", "left_semi").withColumn("route", route)


def with_bucket(files: DataFrame, location: int, prefix: str) -> DataFrame:
    """Adds ``bucket``, by the site's prefix, and an empty ``folder``."""
    if location not in LOCATIONS:
        raise ValueError(f"location {location} has no buckets")
    return files.withColumn("bucket", bucket_of(F.col("obs_id"), prefix)).withColumn("folder", F.lit(None).cast("string"))


def dispatch_subfiles(headers: DataFrame, host_mode: str, dumps: DataFrame, free_corr_bf: bool = False, mode_prefix: str = "") -> DataFrame:
    """Adds ``action`` to subfiles (``obs_id, subobs_id, mode``): dump, process, drain or ignore, ``pause`` and ``free``.

    ``host_mode`` C takes correlator and voltage modes, B beamformer modes. A mode that is both counts as
    correlator first, so B hosts ignore it and don't free it, unless ``free_corr_bf``.
    ``dumps``: windows ``start_gps, end_gps``, end excluded, of any length and number: a subfile is in one of them if the latest
    end of those that have started by then is after it, which is a running maximum along time.
    """
    mode, top = F.col("mode"), F.lit(2**63 - 1)
    files = headers.withColumns({"_at": F.col("subobs_id"), "_step": F.lit(1), "_end": F.lit(None).cast("bigint")})
    # a window without a start or an end is open there
    windows = dumps.select(F.col("start_gps").cast("bigint").alias("_at"), F.lit(0).alias("_step"), F.coalesce(F.col("end_gps").cast("bigint"), top).alias("_end"))
    along = files.unionByName(windows, allowMissingColumns=True).withColumn("_slot", slot_of(F.col("_at"))).withColumn("_span", F.floor(F.col("_slot") / 1024))
    rows = running(along, [], ["_slot", "_span"], [F.col("_at").asc(), F.col("_step").asc()], {"_end": F.max}).where("_step = 1")
    rows = rows.withColumn("_dump", F.col("_end") > F.col("subobs_id")).select(*headers.columns, "_dump")
    corr, vcs, beam = (is_mode(mode, k, mode_prefix) for k in ("correlator", "vcs", "beamformer"))
    action = (
        F.when(F.col("_dump"), "dump")
        .when(corr | vcs, F.when(F.lit(host_mode == "C"), "process").otherwise("ignore"))
        .when(beam, F.when(F.lit(host_mode == "B"), "process").otherwise("ignore"))
        .when(is_mode(mode, "no_capture") | is_mode(mode, "buffer", mode_prefix), "drain")
        .otherwise("ignore")
    )
    rows = rows.withColumn("action", action).drop("_dump")
    stuck = corr & beam & F.lit(host_mode == "B" and not free_corr_bf)
    return rows.withColumn("pause", (F.col("action") == "process") & vcs).withColumn("free", (F.col("action") != "dump") & ~stuck)


def parse_names(df: DataFrame, kind: str, col: str = "path") -> DataFrame:
    """Columns parsed from names. Kinds: beam, solution, channels, url, host; what doesn't fit gives nulls."""
    text, name = F.col(col), basename(F.col(col))
    part = lambda p, i: F.nullif(F.regexp_extract(name, p, i), F.lit("")).try_cast("bigint")
    if kind == "beam":
        p = r"^([0-9]{10})_([0-9]{10})_ch([0-9]{1,3})_beam([0-9]{2})\.(?:vdif|hdr|fil)$"
        cols = {"obs_id": part(p, 1), "subobs_id": part(p, 2), "rec_chan": part(p, 3), "beam": part(p, 4)}
        stitched = F.regexp_replace(text, r"([0-9]{10})_[0-9]{10}(_ch[0-9]{1,3}_beam[0-9]{2}\.[a-z]+)$", "$1$2")
        return df.withColumns(cols | {"stitched": F.when(cols["obs_id"].isNotNull(), stitched)})
    if kind == "solution":
        p = r"^([0-9]+)_(?:ch([0-9]{1,3})(?:-([0-9]{1,3}))?_)?solutions\.(?:fits|bin)$"
        first = part(p, 2)
        return df.withColumns({"obs_id": part(p, 1), "chan_from": first, "chan_to": F.coalesce(part(p, 3), first), "all_chans": part(p, 1).isNotNull() & first.isNull()})
    if kind == "channels":
        p = r"_ch([0-9]{1,3})(?:-([0-9]{1,3}))?_"
        return df.withColumns({"chan_from": part(p, 1), "chan_to": F.coalesce(part(p, 2), part(p, 1))})
    if kind == "url":
        return df.withColumn("basename", F.nullif(basename(F.try_parse_url(text, F.lit("PATH"))), F.lit("")))
    if kind == "host":
        return df.withColumn("host", F.nullif(F.regexp_extract(text, r"^(?:[^@:/]+@)?([^@:/]+):/", 1), F.lit("")))
    raise ValueError(f"unknown kind of name: {kind}")


#: Text in a file's name and its description; the first that occurs counts.
DESCRIPTIONS = [
    ("birli_readme.txt", "Full log output of the Birli run"),
    ("hyperdrive_readme.txt", "Full log output of the Hyperdrive run"),
    ("intercepts.png", "Plots showing, for each reciever type and polarisation, a plot of the phase intercepts in polar coordinates vs cable length"),
    ("phase_fits_xx.png", "Plot of the phase fit for each tile (phase vs frequency) for XX"),
    ("phase_fits_yy.png", "Plot of the phase fit for each tile (phase vs frequency) for YY"),
    ("phase_fits.tsv", "Tab separated values (TSV) file containing all of the phase fit statistics per tile"),
    ("rx_lengths.png", "Cable length offsets in metres per receiver"),
    ("solutions_amps.png", "Calibration solution amplitudes vs fine channel per tile"),
    ("solutions_phases.png", "Calibration solution phase vs fine channel per tile"),
    ("stats.txt", "Hyperdrive fine channel convergence statistics"),
    ("residual.tsv", "Tab separated value (TSV) file of phase residuals vs frequency by receiver type and polarisation"),
    ("residual.png", "Plot of phase residuals vs frequency by receiver type and polarisation"),
]


def with_description(df: DataFrame, col: str = "filename") -> DataFrame:
    """Adds ``description``: by the first rule that fits, and the channels with their frequency (1.28 MHz each)."""
    name = F.col(col)
    text = F.coalesce(*[F.when(name.contains(k), F.lit(v)) for k, v in DESCRIPTIONS])
    first, last = (F.regexp_extract(name, "_ch([0-9]{1,3})(?:-([0-9]{1,3}))?_", i) for i in (1, 2))
    mhz = lambda c: F.format_string("%.3f", c.try_cast("double") * 1.28)
    one = F.concat(F.lit(" for receiver channel "), first, F.lit(" ("), mhz(first), F.lit(" MHz)"))
    many = F.concat(F.lit(" for receiver channels "), first, F.lit("-"), last, F.lit(" ("), mhz(first), F.lit(" - "), mhz(last), F.lit(" MHz)"))
    channels = F.when(first == "", " for all coarse channels").when(last == "", one).otherwise(many)
    return df.withColumn("description", F.coalesce(F.concat(text, channels), F.lit("Miscellaneous file")))


def preprocess_plan(observations: DataFrame, edge_hz: int, target_hz: int, target_ms: int) -> DataFrame:
    """``obs_id, edge_width_hz, edge_ok, avg_freq_hz, avg_time_ms``; an average is null where the data are coarse enough."""
    fine = F.col("fine_chan_width_hz")
    edge = F.when(F.col("oversampled"), F.lit(0)).otherwise(F.greatest(fine, F.lit(edge_hz)))
    return observations.select(
        "obs_id", edge.alias("edge_width_hz"), (edge % fine == 0).alias("edge_ok"),
        F.when(fine < target_hz, F.lit(target_hz)).alias("avg_freq_hz"), F.when(F.col("int_time_ms") < target_ms, F.lit(target_ms)).alias("avg_time_ms"),
    )


def estimate_output(observations: DataFrame, target_hz: int, target_ms: int, small_gb: int = 500) -> DataFrame:
    """``obs_id, bytes, gb, use_temp``: 13 bytes for each step, fine channel, baseline and polarisation product."""
    steps = F.floor(F.col("sched_duration_ms") / F.greatest(F.col("int_time_ms"), F.lit(target_ms)))
    fine = F.floor(F.col("coarse_chan_width_hz") / F.greatest(F.col("fine_chan_width_hz"), F.lit(target_hz)))
    size = (steps * F.col("num_coarse") * fine * F.col("num_baselines") * F.col("num_pols") * 13).cast("bigint")
    gb = F.greatest(F.floor(size / 1e9), F.lit(1)).cast("bigint")
    return observations.select("obs_id", size.alias("bytes"), gb.alias("gb"), (gb < small_gb).alias("use_temp"))


def classify_tool_output(lines: DataFrame, service: str, col: str = "text") -> DataFrame:
    """Adds ``outcome`` (new_job, existing_job, error_code, outage, transient) and ``number``, first that fits; ``service`` is the job service's name."""
    text = F.col(col)
    rules = [
        ("new_job", rf"as \Q{service}\E job ID ([0-9]+)"),
        ("existing_job", "Job already (?:queued, processing|running) or complete. Job Id: ([0-9]+)"),
        ("error_code", '"error_code": ([0-9]+)'),
        ("outage", "archive location of the observation is down|No obs locations found|outage"),
    ]
    outcome = F.coalesce(*[F.when(text.rlike(p), F.lit(n)) for n, p in rules], F.lit("transient"))
    number = F.coalesce(*[F.when(text.rlike(p), F.regexp_extract(text, p, 1)) for _, p in rules[:3]]).try_cast("bigint")
    return lines.withColumns({"outcome": outcome, "number": number})


def beam_headers(products: DataFrame, observations: DataFrame, beams: DataFrame, coarse_chans: DataFrame) -> DataFrame:
    """One row for each stitched product: source, position, sample time, frequency and width.

    Beam values go before the observation's, and start positions before these; 0 counts as missing.
    """
    given = lambda c: F.nullif(F.col(c), F.lit(0.0))
    return (
        products.join(observations.select("obs_id", "obs_name", "obs_ra_deg", "obs_dec_deg"), "obs_id", "left")
        .join(beams.withColumnRenamed("beam_no", "beam"), ["obs_id", "beam"], "left")
        .join(coarse_chans.select("obs_id", "rec_chan", "centre_hz", "width_hz"), ["obs_id", "rec_chan"], "left")
        .select(
            "obs_id", "rec_chan", "beam", F.coalesce("target_name", "obs_name").alias("source"),
            F.coalesce(given("start_ra_deg"), given("ra_deg"), F.col("obs_ra_deg")).alias("ra_deg"),
            F.coalesce(given("start_dec_deg"), given("dec_deg"), F.col("obs_dec_deg")).alias("dec_deg"),
            F.try_divide(F.lit(1e6), F.col("frequency_resolution_hz")).alias("tsamp_us"),
            (F.col("centre_hz") / 1e6).alias("freq_mhz"), (F.col("width_hz") / 1e6).alias("bw_mhz"),
        )
    )


def numbers_of(df: DataFrame, col: str, kind: str = "double") -> DataFrame:
    return df.withColumn(col, number_list(F.col(col), kind))
