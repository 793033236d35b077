"""Plan building blocks shared by the strategies."""
