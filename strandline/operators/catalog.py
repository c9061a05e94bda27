"""The default reference catalog: one accession for each genotype."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Genotype and accession of the default references.
REFERENCES = """
1a EF407457.1
1b EU781828.1
2a D00944.1
2b D10988.1
3a D17763.1
4a DQ418789.1
4d FJ462437.1
5a AF064490.1
5b PQ899568.1
6a AY859526.1
1c AY051292.1
1d KJ439768.1
1e KC248194.1
1g AM910652.2
1h KC248198.1
1i KJ439772.1
1j KJ439773.1
1k KJ439774.1
1l KC248193.1
1m KJ439778.1
1n KJ439775.1
1o KJ439779.1
2c D50409.1
2d JF735114.1
2e JF735120.1
2f KC844042.1
2i DQ155561.1
2j HM777359.1
2k AB031663.1
2l KC197235.1
2m JF735111.1
2q FN666428.2
2r JF735115.1
2t KC197238.1
2u JF735112.1
2v MW041295.1
3b D49374.1
3d KJ470619.1
3e KJ470618.1
3g JF735123.1
3h JF735121.1
3i FJ407092.1
3k D63821.1
4b FJ462435.1
4c FJ462436.1
4f EU392174.1
4g FJ462432.1
4k EU392171.1
4l FJ839870.1
4m FJ462433.1
4n FJ462441.1
4o FJ462440.1
4p FJ462431.1
4q FJ462434.1
4r FJ462439.1
4s JF735136.1
4t FJ839869.1
4v JX227959.1
4w FJ025855.1
6b D84262.2
6c EF424629.1
6d D84263.2
6e DQ314805.1
6f DQ835760.1
6g D63822.1
6h D84265.2
6i DQ835762.1
6j DQ835761.1
6k D84264.2
6l EF424628.1
6m DQ835766.1
6n DQ278894.1
6o EF424627.1
6p EF424626.1
6q EF424625.1
6r EU408328.1
6s EU408329.1
6t EF632071.1
6u EU246940.1
6v EU158186.1
6w DQ278892.1
7a EF108306.2
7b KX092342.1
8a MH590698.1
"""


def references(overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Accessions by genotype; ``overrides`` (see ``reference_map``) win and may add genotypes."""
    return {**dict(line.split() for line in REFERENCES.strip().splitlines()), **(overrides or {})}


def catalog(spark: SparkSession, overrides: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(list(references(overrides).items()), "genotype string, accession string")
