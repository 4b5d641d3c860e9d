"""vertexloom: region, raster, spot and transform analytics as Spark DataFrame operators."""
