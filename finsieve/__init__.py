"""finsieve: Spark-native operators for finding rare illicit payments in large ledgers."""
