"""Plans: the pipeline, and queries over the tables of a data folder."""
