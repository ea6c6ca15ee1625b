"""Analytics over structured technical documents as Spark jobs: from text blocks to a validated graph and its queries."""
