"""A DataFrame engine for tandem-repeat variation in sequencing data."""
