"""Input tables: ERP-shaped fixtures, parquet/catalog resolution, holiday CSV."""
