"""Review-text analytics on PySpark: cleaning, TF-IDF, naive Bayes and word reports."""
