"""Checks before a run: profiles a step can't run under, batch settings, and options that become flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lattica.functions import scalars as S

BARRED = ("conda", "mamba")


def any_of(items: Column, wanted: Column) -> Column:
    """Whether two arrays have an item in common; false if either is null."""
    return F.coalesce(F.arrays_overlap(items, wanted), F.lit(False))


def barred_profile(profile: Column, step: Column, barred: tuple[str, ...] = BARRED) -> Column:
    """An error if a comma-separated profile names a barred one, else null."""
    hit = any_of(S.tokens(F.coalesce(profile, F.lit(""))), F.array(*map(F.lit, barred)))
    return F.when(hit, F.concat(step, F.lit(" does not run under "), F.lit(" or ".join(barred)), F.lit("; use a container profile")))


def batch_problem(profile: Column, queue: Column, region: Column, outdir: Column) -> Column:
    """What a run on a cloud batch service lacks: queue and region, then an output folder in its store; null if nothing."""
    on = F.coalesce(F.contains(profile, F.lit("awsbatch")), F.lit(False))
    return F.coalesce(
        F.when(on & ~(S.truthy(queue) & S.truthy(region)), F.lit("a batch run needs --awsqueue and --awsregion")),
        F.when(on & ~F.coalesce(F.startswith(outdir, F.lit("s3:")), F.lit(False)), F.lit("a batch run needs --outdir in s3:")),
    )


def unconfigured(profile: Column, config_files: Column) -> Column:
    """Whether a run has neither a profile nor a configuration of its own."""
    return (profile == "standard") & (config_files <= 1)


def stain_flag(name: str, c: Column) -> Column:
    """--name=disable for any truthy value, as built; that a stain's name could be given is in the contract only."""
    return F.when(S.truthy(c), F.lit(f"--{name}=disable")).otherwise("")
