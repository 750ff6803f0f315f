"""Settings for a session on an external Iceberg REST catalog."""

from __future__ import annotations

from collections.abc import Sequence


def rest_catalog_settings(
    name: str,
    uri: str,
    token: str,
    warehouse: str | None = None,
    scope: str | None = None,
    vended_credentials: bool = True,
    vectorized_reads: bool = False,
    jars: Sequence[str] = (),
) -> dict[str, str]:
    """Spark settings that make ``name`` the default catalog of a session."""
    if not token:
        raise ValueError("a catalog token is required")
    prefix = f"spark.sql.catalog.{name}"
    settings = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        "spark.sql.defaultCatalog": name,
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "rest",
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse or name,
        f"{prefix}.credential": token,
        "spark.sql.iceberg.vectorization.enabled": str(vectorized_reads).lower(),
    }
    if scope:
        settings[f"{prefix}.scope"] = scope
    if vended_credentials:
        settings[f"{prefix}.header.X-Iceberg-Access-Delegation"] = "vended-credentials"
    if jars:
        settings["spark.jars"] = ",".join(jars)
    return settings
