"""Raw CSV scan and the partitioned lake tables."""
