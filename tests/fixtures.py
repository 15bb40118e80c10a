"""Own sample tables (FIXTURES.md §2) as DataFrames."""

from genrec.functions.genres import parse_pipe

# pairs in list order: Crime>Drama 2, Crime>War 2, Drama>War 3, Drama>Crime 1, War>Crime 1, Horror>Crime 1
MODEL_MOVIES = [(11, 4.0, "Crime|Drama|War|"), (12, 3.5, "War|Crime|"), (13, 2.5, "Drama|War|"),
                (14, 5.0, "Crime|Drama|"), (15, 3.0, "Horror|Crime|"), (16, 4.5, "Drama|Crime|War|")]
MODEL_USERS = [(1, "Crime|War|"), (2, "Horror|"), (3, "Drama|"), (4, "War|Horror|")]
# user 3 meets equal scores (movies 13 and 12 differ, 11 and 16 do not tie); user 4 has no positive rating
MODEL_TEST = [(1, 13, 4.0, 10), (1, 14, 2.0, 11), (1, 15, 3.5, 12), (2, 12, 3.0, 20), (2, 13, 1.5, 21),
              (2, 15, 5.0, 22), (3, 11, 3.0, 30), (3, 12, 4.5, 31), (3, 14, 2.5, 32), (4, 11, 2.0, 40),
              (4, 12, 0.5, 41), (4, 16, 1.0, 42)]

PREDICTIONS = [(7, "31:5.0|8:4.4|22:4.4|40:0.25"), (8, "22:3.0|99:2.5|31:1.0"), (9, "8:0.0")]
TITLES = [(8, " Harbour Lights (1951)"), (22, "The Long Ferry (1987)"), (31, "Nine Doors (2003)"), (40, "Salt (1966) ")]


def model_sample(spark):
    movies = spark.createDataFrame(MODEL_MOVIES, "movieid int, avgrating double, g string") \
        .select("movieid", "avgrating", parse_pipe("g").alias("genres"))
    fav = spark.createDataFrame(MODEL_USERS, "userid int, g string") \
        .select("userid", parse_pipe("g").alias("favgenres"))
    test = spark.createDataFrame(MODEL_TEST, "userid int, movieid int, rating double, timestamp bigint")
    test = test.join(movies.select("movieid", "genres"), "movieid")
    return movies, fav, test


def unseen_sample(spark):
    """Two users: one has rated every movie; two movies tie for the other."""
    movies = spark.createDataFrame(
        [(21, 4.0, ["War", "Crime"]), (22, 4.0, ["War", "Crime"]), (23, 2.0, ["Opera"])],
        "movieid int, avgrating double, genres array<string>")
    training = spark.createDataFrame(
        [(5, 21, 4.0, 1, ["War", "Crime"]), (5, 22, 4.0, 2, ["War", "Crime"]), (5, 23, 2.0, 3, ["Opera"]),
         (6, 23, 2.0, 4, ["Opera"])],
        "userid int, movieid int, rating double, timestamp bigint, genres array<string>")
    fav = spark.createDataFrame([(5, ["War"]), (6, ["War", "Opera"])], "userid int, favgenres array<string>")
    return training, movies, fav


def serving_sample(spark):
    return (spark.createDataFrame(PREDICTIONS, "userid int, recommendations string"),
            spark.createDataFrame(TITLES, "movieid int, title string"))
