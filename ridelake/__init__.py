"""Ride-fare lake: keyed ride events -> typed raw table -> regions -> curated table."""
