"""Image-level statistics: view labels, completeness per study, patches, tag sums."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.clean import col, label_of
from cohortloom.functions.uids import pseudo_uid

# View codes and their short names.
VIEW_CODES = {
    "R-10224": "ml",
    "R-10226": "mlo",
    "R-10228": "lm",
    "R-10230": "lmo",
    "R-10242": "cc",
    "R-10244": "fb",
    "R-102D0": "sio",
    "R-40AAA": "iso",
    "R-1022A": "xccl",
    "R-1024B": "xccm",
    "G-8310": "?",
}
SIDED_VIEWS = ("rcc", "lcc", "rmlo", "lmlo")

# Column names of the patch file.
PATCH_COLUMNS = (
    "StudyInstanceUID_0020000d",
    "SOPInstanceUID_0x00080018",
    "ImageLaterality_0x00200062",
    "ViewCodeSequence_0x00540220_CodeValue_0x00080100",
    "ViewCodeSequence_0x00540220_CodeMeaning_0x00080104",
    "ViewCodeSequence_0x00540220_CodingSchemeDesignator_0x00080102",
)


def sided(view: Column, laterality: str | Column) -> Column:
    """`mlo` and `cc` with the side in front; every side but R counts as left."""
    side = F.when(F.upper(col(laterality)) == "R", "r").otherwise("l")
    return F.when(view.isin("mlo", "cc"), F.concat(side, view)).otherwise(view)


def view_label(code: str | Column, laterality: str | Column, strict: bool = True) -> Column:
    """View name from code and laterality: `N/A` without either, unlisted codes raise."""
    code, laterality = col(code), col(laterality)
    known = label_of(code, VIEW_CODES)
    if strict:
        known = F.coalesce(known, F.raise_error(F.concat(F.lit("unlisted view code "), code)))
    return F.when(code.isNull() | laterality.isNull(), "N/A").otherwise(sided(known, laterality))


def position_label(position: str | Column, laterality: str | Column) -> Column:
    """View name from the view position text; null for other positions or missing tags."""
    view = F.lower(col(position))
    return F.when(view.isin("mlo", "cc") & col(laterality).isNotNull(), sided(view, laterality))


def view_counts(images: DataFrame, study: str, label: Column) -> DataFrame:
    """Per study the number of images of each of the four views, all images, completeness."""
    counted = images.select(F.col(study), label.alias("_view")).groupBy(study).agg(
        *[F.count_if(F.col("_view") == v).alias(v) for v in SIDED_VIEWS],
        F.count("*").alias("images"),
    )
    return counted.withColumns(
        {
            "complete": F.least(*SIDED_VIEWS) >= 1,
            "overpopulated": F.greatest(*SIDED_VIEWS) > 1,
        }
    )


def completeness(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count_if("complete").alias("complete_studies"), F.count("*").alias("studies")
    ).withColumn("ratio", F.try_divide(F.col("complete_studies"), F.col("studies")))


def overpopulation(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count_if("overpopulated").alias("overpopulated_studies"), F.count("*").alias("studies")
    ).withColumn("frequency_pct", F.try_divide(100 * F.col("overpopulated_studies"), F.col("studies")))


def broken_studies(images: DataFrame, study: str, modality: str) -> DataFrame:
    """Main causes: too few files, other; ultrasound images and the studies that have any."""
    per_study = images.groupBy(study).agg(
        F.count("*").alias("files"), F.count_if(F.col(modality) == "US").alias("us")
    )
    return per_study.agg(
        F.count_if(F.col("files") < 4).alias("fewer_than_4"),
        F.count_if(F.col("files") >= 4).alias("other_causes"),
        F.coalesce(F.sum("us"), F.lit(0)).alias("us_images"),
        F.count_if(F.col("us") > 0).alias("us_studies"),
    )


def large_studies(images: DataFrame, study: str, more_than: int = 4) -> DataFrame:
    counted = images.groupBy(study).agg(F.count("*").alias("files"))
    return counted.filter(F.col("files") > more_than)


def studies_of_patient(images: DataFrame, patient: str, value: object, study: str) -> DataFrame:
    return images.filter(F.col(patient) == F.lit(value)).select(study).distinct()


def tag_column(columns: Sequence[str], tag: str) -> str:
    """The one column whose name contains the tag."""
    hits = [c for c in columns if tag in c]
    if len(hits) != 1:
        raise ValueError(f"{len(hits)} columns contain {tag}: {hits}")
    return hits[0]


def tag_sum(meta: DataFrame, tag: str, kind: str | T.DataType = "decimal(38,6)") -> DataFrame:
    """Sum of the tag's column; decimal by default, so that the order of addition is irrelevant."""
    name = tag_column(meta.columns, tag)
    return meta.agg(F.sum(F.col(f"`{name}`").cast(kind)).alias("total"))


def same_tag_sum(before: DataFrame, after: DataFrame, tag: str) -> DataFrame:
    """Totals before and after de-identification and whether they are equal."""
    sums = [
        tag_sum(df, tag).select(F.lit(side).alias("side"), "total")
        for side, df in (("before", before), ("after", after))
    ]
    both = sums[0].unionByName(sums[1])
    return both.agg(
        F.max(F.when(F.col("side") == "before", F.col("total"))).alias("before"),
        F.max(F.when(F.col("side") == "after", F.col("total"))).alias("after"),
    ).withColumn("equal", F.coalesce(F.col("before") == F.col("after"), F.lit(False)))


def patch_rows(
    images: DataFrame,
    org_root: str,
    id_random: str = "id_random",
    study: str = "study_uid",
    image: str = "sop_uid",
    laterality: str = "laterality",
    code: str = "view_code",
    meaning: str = "view_meaning",
    scheme: str = "view_scheme",
) -> DataFrame:
    values = (
        pseudo_uid(id_random, study, org_root),
        pseudo_uid(id_random, image, org_root),
        F.col(laterality), F.col(code), F.col(meaning), F.col(scheme),
    )
    return images.select(*[v.alias(name) for v, name in zip(values, PATCH_COLUMNS)])


def score_totals(results: DataFrame) -> DataFrame:
    """Sums over landed text-recognition results: words found, words shown, tp/tn/fp/fn."""
    names = ("recognized_words", "total_words", "tp", "tn", "fp", "fn")
    return results.agg(*[F.sum(c).alias(c) for c in names])


def recognized_words(results: DataFrame, words: str = "words") -> DataFrame:
    """Every recognised word with the number of times it was seen."""
    return results.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("seen"))
