"""terrane: Spark-native analytics over tables of sites and the data attached to them."""
