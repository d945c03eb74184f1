"""rigprep: Spark jobs that prepare multi-camera captures, many scenes at once."""
