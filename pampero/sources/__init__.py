"""Raw snapshot tables, reference CSVs and date windows."""
