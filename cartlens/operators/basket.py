"""Category pairs bought on the same invoice.

The count for (A, B), A != B, equals the number of line pairs of the plain
self-join ``a.invoice = b.invoice AND a.category != b.category``, which is
``sum over invoices of n_A * n_B``. Lines are first reduced to one row per
(invoice, category) with its line count (partial aggregation before the
shuffle), so the join sees at most one row per distinct category per invoice:
an invoice with millions of lines still contributes at most C*(C-1) pairs
where C is the size of the category domain, never n^2 line pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def basket_pairs(lines: DataFrame, invoice: str = "invoice_no", item: str = "category") -> DataFrame:
    per_invoice = (lines.where(F.col(invoice).isNotNull() & F.col(item).isNotNull())
                   .groupBy(invoice, item)
                   .agg(F.count("*").alias("n")))
    a = per_invoice.select(F.col(invoice).alias("inv"), F.col(item).alias("category1"),
                           F.col("n").alias("n1"))
    b = per_invoice.select(F.col(invoice).alias("inv"), F.col(item).alias("category2"),
                           F.col("n").alias("n2"))
    return (a.join(b, "inv")
            .where(F.col("category1") != F.col("category2"))
            .groupBy("category1", "category2")
            .agg(F.sum(F.col("n1") * F.col("n2")).alias("count"))
            .orderBy(F.desc("count"), "category1", "category2"))
