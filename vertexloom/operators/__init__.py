"""DataFrame operators on regions, rasters, spots, frames and transforms."""
