"""The jobs: bronze slices, silver cleaning, gold stores, delinquency tables, quality tables, backfill."""
